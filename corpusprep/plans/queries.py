"""Registered queries: one per operator of the coverage list, each reading the provided tables.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame whose columns are plain
scalars (arrays rendered as space-joined strings) so results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions import pycode, pynames, sqlcode, text
from corpusprep.operators import corpus, encode, lemma, repl, tagging, vectors, vocab
from corpusprep.operators.tokenise import tokenise_corpus
from corpusprep.plans import derive, stages
from corpusprep.plans.derive import table
from corpusprep.session import ensure_checkpoint_dir
from corpusprep.sources import io


def _round4(x: Column) -> Column:
    """Round for cross-engine comparison; ``+ 0.0`` turns a rounded ``-0.0`` into ``0.0``."""
    return F.round(x, 4) + F.lit(0.0)


def _paired(spark, sf_dir) -> Callable[[DataFrame], DataFrame]:
    """Test vectors for a vocabulary, from the embeddings table."""
    return lambda words: derive.word_vectors(words, table(spark, sf_dir, "embeddings"))


def _j(arr) -> Column:
    return F.array_join(F.col(arr) if isinstance(arr, str) else arr, " ")


def _docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _doc_rule(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return _docs(spark, sf_dir).select("doc_id", fn(F.col("text")).alias("out"))
    return run


def _doc_tokens(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return _docs(spark, sf_dir).select("doc_id", _j(fn(F.col("text"))).alias("tokens"))
    return run


def _contractions(dialect):
    def run(spark, sf_dir):
        return derive.contraction_text(spark, sf_dir).select(
            "id", text.expand_contractions("text", dialect).alias("out"))
    return run


# -- tokens of the documents, shared by the vocabulary / dictionary / encode queries --------------

def _doc_query_tokens(spark, sf_dir, dialect="python"):
    return _docs(spark, sf_dir).select("doc_id", text.query_tokens("text", dialect).alias("t"))


class _DocStage:
    """Document tokens, vocabulary, word vectors and dictionary of one query run.

    The token table is checkpointed once (the reference writes its token file once, too),
    so vocabulary, vector pairing, numbering and lookup all start from it instead of
    re-running the text rules.
    """

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir
        self.tokens = _doc_query_tokens(spark, sf_dir).checkpoint(eager=True)
        self.vocab = vocab.build_vocab(self.tokens, fields=["t"]).checkpoint(eager=True)
        words = self.vocab.unionByName(derive.benchmark_vocab(spark, sf_dir)).distinct()
        self.vectors = derive.word_vectors(words, table(spark, sf_dir, "embeddings"))
        self._dictionary = None

    @property
    def dictionary(self):
        if self._dictionary is None:
            self._dictionary = vectors.build_dictionary(self.vocab, self.vectors, seed=7)
        return self._dictionary


# -- queries --------------------------------------------------------------------------------------

def q_lemma_join(spark, sf_dir):
    toks = _doc_query_tokens(spark, sf_dir).checkpoint(eager=True)
    table_ = lemma.plural_lemmas(vocab.build_vocab(toks, fields=["t"]).checkpoint(eager=True))
    return lemma.lemma_join(toks, table_, "doc_id", "t").select("doc_id", _j("t").alias("tokens"))


def q_lemma_pos_join(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), text.query_tokens("text").alias("t")).checkpoint(eager=True)
    tables = derive.tag_tables(vocab.build_vocab(turns, fields=["t"]).checkpoint(eager=True))
    return tagging.lemma_pos_join(turns, "id", "t", *tables).select("id", _j("t").alias("tokens"), F.array_join("classes", "").alias("classes"))


def q_python_clean(spark, sf_dir):
    return derive.python_snippets(spark, sf_dir).select("id", pycode.python_clean("code").alias("clean"))


def q_python_vars(spark, sf_dir):
    s = derive.python_snippets(spark, sf_dir)
    return s.select("id", _j(pycode.python_vars(pycode.python_clean("code"))).alias("vars"))


def q_python_vars_all(spark, sf_dir):
    s = derive.python_snippets(spark, sf_dir)
    return s.select("id", _j(pycode.python_vars(pycode.python_clean("code"), all_matches=True)).alias("vars"))


def q_python_code_tokens(spark, sf_dir):
    return derive.python_snippets(spark, sf_dir).select("id", _j(pycode.python_code_tokens("code")).alias("tokens"))


def q_python_stored_names(spark, sf_dir):
    return derive.python_statements(spark, sf_dir).select("id", _j(pynames.stored_names("code")).alias("names"))


def q_python_lexemes(spark, sf_dir):
    lexemes = F.transform(pynames.raw_lexemes("code"), lambda t: F.replace(t, F.lit("\n"), F.lit("~")))
    return derive.python_statements(spark, sf_dir).select("id", F.array_join(lexemes, " | ").alias("lexemes"))


def q_python_statement_tokens(spark, sf_dir):
    return derive.python_statements(spark, sf_dir).select("id", _j(pycode.python_code_tokens("code")).alias("tokens"))


def _sql_sanitised(spark, sf_dir):
    return derive.sql_snippets(spark, sf_dir).select(
        "id", sqlcode.sql_sanitise(sqlcode.sql_clean("code")).alias("s"))


def q_sql_clean(spark, sf_dir):
    return derive.sql_snippets(spark, sf_dir).select("id", sqlcode.sql_clean("code").alias("clean"))


def q_sql_sanitise(spark, sf_dir):
    return _sql_sanitised(spark, sf_dir).select("id", F.coalesce("s", F.lit("-1000")).alias("sanitised"))


def q_sql_kinds(spark, sf_dir):
    kinds = sqlcode.sql_kinds("s")
    pairs = F.transform(kinds, lambda x: F.concat(x["tok"], F.lit("/"), x["kind"]))
    return _sql_sanitised(spark, sf_dir).filter(F.col("s").isNotNull()).select("id", _j(pairs).alias("kinds"))


def q_sql_from_region(spark, sf_dir):
    flags = F.transform(sqlcode.sql_from_region("s"), lambda b: F.when(b, F.lit("1")).otherwise(F.lit("0")))
    return _sql_sanitised(spark, sf_dir).filter(F.col("s").isNotNull()).select(
        "id", F.array_join(flags, "").alias("in_from"))


def q_sql_rename(spark, sf_dir):
    return _sql_sanitised(spark, sf_dir).filter(F.col("s").isNotNull()).select(
        "id", _j(sqlcode.sql_rename(sqlcode.sql_kinds("s"), regex=False)).alias("renamed"))


def q_sql_string_patterns(spark, sf_dir):
    strings = F.filter(sqlcode.sql_kinds("s"), lambda x: x["kind"] == "STRING")
    pats = F.transform(strings, lambda x: sqlcode.string_pattern_tokens(x["tok"]))
    return _sql_sanitised(spark, sf_dir).filter(F.col("s").isNotNull()).select(
        "id", F.array_join(pats, " | ").alias("patterns"))


def q_subquery_count(spark, sf_dir):
    return derive.sql_snippets(spark, sf_dir).select("id", sqlcode.subquery_count("code").cast("long").alias("n"))


def q_subquery_spans(spark, sf_dir):
    spans = derive.sql_nested(spark, sf_dir).select("id", F.explode(sqlcode.subquery_groups("code")).alias("g"))
    return spans.select("id", *[F.col(f"g.{c}").cast("long").alias(c) for c in ("start", "end", "depth")])


def q_sql_code_tokens(spark, sf_dir):
    s = derive.sql_snippets(spark, sf_dir).select("id", sqlcode.sql_code_parse("code").alias("p"))
    return s.select("id", _j("p.tokens").alias("tokens"), F.col("p.ok").alias("code_ok"))


def q_repl_flags(spark, sf_dir):
    return derive.prompt_snippets(spark, sf_dir).select("id", repl.repl_flags("code").alias("flags"))


def q_repl_layout(spark, sf_dir):
    return derive.prompt_snippets(spark, sf_dir).select("id", repl.repl_layout("code").alias("layout"))


def q_repl_repair(spark, sf_dir):
    return repl.repl_repair(derive.prompt_snippets(spark, sf_dir))


def q_repl_blocks(spark, sf_dir):
    return repl.repl_blocks(derive.prompt_snippets(spark, sf_dir)).select(
        "id", F.col("block_no").cast("long").alias("block_no"), "block")


def _qid_cols():
    return [F.col("qid.question_id").alias("question_id"), F.col("qid.cand").cast("long").alias("cand")]


def q_flatten_record(spark, sf_dir):
    nested = corpus.nest_record(derive.raw_corpus(spark, sf_dir))
    return corpus.flatten_record(nested).select(*_qid_cols(), "ctx1", "ctx2", "code", "query")


def q_tokenise_corpus(spark, sf_dir):
    t = tokenise_corpus(derive.raw_corpus(spark, sf_dir))
    return t.select(*_qid_cols(), "lang", _j("ctx1_tokens").alias("ctx1_tokens"),
                    _j("ctx2_tokens").alias("ctx2_tokens"), _j("code_tokens").alias("code_tokens"),
                    _j("query_tokens").alias("query_tokens"), "code_ok")


def q_candidate_counts(spark, sf_dir):
    return corpus.candidate_counts(derive.raw_corpus(spark, sf_dir))


def q_split_single(spark, sf_dir):
    single, _ = corpus.split_candidates(derive.raw_corpus(spark, sf_dir))
    return single.select(*_qid_cols(), "lang")


def q_split_multiple(spark, sf_dir):
    _, multiple = corpus.split_candidates(derive.raw_corpus(spark, sf_dir))
    return multiple.select(*_qid_cols(), "lang")


def q_label_singles(spark, sf_dir):
    single, _ = corpus.split_candidates(derive.raw_corpus(spark, sf_dir))
    return corpus.label_singles(single).select(*_qid_cols(), F.col("label").cast("long").alias("label"))


def q_count_value(spark, sf_dir):
    t = _doc_query_tokens(spark, sf_dir)
    return t.select("doc_id", corpus.count_value("t", "tagint").cast("long").alias("n_tagint"))


def q_vocab_one(spark, sf_dir):
    return derive.document_vocab(spark, sf_dir)


def q_vocab_union(spark, sf_dir):
    docs = _docs(spark, sf_dir).select(text.context_tokens("text", "sql").alias("t"))
    bench = table(spark, sf_dir, "benchmark").select(text.context_tokens("text", "sql").alias("t"))
    return vocab.build_vocab(docs, bench, fields=["t"])


def q_new_words(spark, sf_dir):
    docs = _doc_query_tokens(spark, sf_dir)
    return vocab.new_words(docs, derive.benchmark_vocab(spark, sf_dir), fields=["t"])


def q_roundtrip_diff(spark, sf_dir):
    t = derive.contraction_text(spark, sf_dir)
    py = t.select("id", _j(text.query_tokens("text", "python")).alias("tokens"))
    sq = t.select("id", _j(text.query_tokens("text", "sql")).alias("tokens"))
    return vocab.roundtrip_diff(py, sq)


def q_new_words_prefiltered(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(text.query_tokens("text").alias("t"))
    return vocab.new_words(turns, derive.document_vocab(spark, sf_dir), fields=["t"], prefilter=True)


def q_roundtrip_diff_by_digest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    changed = docs.filter("doc_id % 101 <> 7").withColumn("lang", F.when(F.col("doc_id") % 97 == 5, F.lit(None)).otherwise(F.col("lang")))
    again = docs.filter("doc_id % 211 = 3")
    return vocab.roundtrip_diff_by_digest(docs, changed.unionByName(again))


def q_word_vectors(spark, sf_dir):
    v = _DocStage(spark, sf_dir).vectors
    return v.select("word", F.col("vec_id").cast("long").alias("vec_id"), F.size("vec").cast("long").alias("dim"),
                    _round4(F.aggregate("vec", F.lit(0.0).cast("double"), lambda a, x: a + x)).alias("vec_sum"))


def q_unit_vectors(spark, sf_dir):
    v = vectors.unit_vectors(_DocStage(spark, sf_dir).vectors)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x))
    return v.select("word", _round4(norm).alias("norm"),
                    _round4(F.get("vec", 0).cast("double")).alias("first"),
                    _round4(F.get("vec", 63).cast("double")).alias("last"))


def q_found_words(spark, sf_dir):
    st = _DocStage(spark, sf_dir)
    return vectors.found_words(st.vocab, st.vectors).select("word", F.size("vec").cast("long").alias("dim"))


def q_failed_words(spark, sf_dir):
    st = _DocStage(spark, sf_dir)
    return vectors.failed_words(st.vocab, st.vectors)


def q_dictionary_numbering(spark, sf_dir):
    return _DocStage(spark, sf_dir).dictionary.select(F.col("idx").cast("long").alias("idx"), "word")


def q_append_numbering(spark, sf_dir):
    st = _DocStage(spark, sf_dir)
    old = vectors.build_dictionary(derive.benchmark_vocab(spark, sf_dir), st.vectors, seed=7)
    ext = vectors.append_dictionary(old, st.vocab, st.vectors)
    return ext.select(F.col("idx").cast("long").alias("idx"), "word")


def q_verify_dictionary(spark, sf_dir):
    st = _DocStage(spark, sf_dir)
    return vectors.verify_dictionary(st.dictionary, st.vectors)


def q_lookup_ids(spark, sf_dir):
    st = _DocStage(spark, sf_dir)
    ids = encode.encode_tokens(st.tokens, "doc_id", "t", st.dictionary, keep=None)
    return ids.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


def q_encode_text(spark, sf_dir):
    st = _DocStage(spark, sf_dir)
    ids = encode.encode_tokens(st.tokens, "doc_id", "t", st.dictionary, keep=100)
    out = encode.fit_length(encode.text_ids("ids"), 100)
    return ids.select("doc_id", F.array_join(out.cast("array<string>"), " ").alias("ids"))


def q_fit_length(spark, sf_dir):
    st = _DocStage(spark, sf_dir)
    toks = _docs(spark, sf_dir).select("doc_id", text.context_tokens("text", "python").alias("t"))
    ids = encode.encode_tokens(toks, "doc_id", "t", st.dictionary, keep=50)
    return ids.select("doc_id", F.array_join(encode.fit_length("ids", 50).cast("array<string>"), " ").alias("ids"))


def q_encode_code(spark, sf_dir):
    code = derive.python_snippets(spark, sf_dir).select("id", pycode.python_code_tokens("code").alias("t"))
    code = code.checkpoint(eager=True)
    words = vocab.build_vocab(code, fields=["t"])
    dictionary = vectors.build_dictionary(words, derive.word_vectors(words, table(spark, sf_dir, "embeddings")),
                                          seed=7)
    ids = encode.encode_tokens(code, "id", "t", dictionary, keep=encode.CODE_CAP)
    out = encode.fit_length(encode.code_ids("ids"), 350)
    return ids.select("id", F.array_join(out.cast("array<string>"), " ").alias("ids"))


def q_encode_corpus(spark, sf_dir):
    enc = stages.encode_raw_corpus(derive.raw_corpus(spark, sf_dir), _paired(spark, sf_dir))["encoded"]
    return enc.select(*_qid_cols(), *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c)
                                      for c in ["ctx1_ids", "ctx2_ids", "code_ids", "query_ids"]],
                      F.col("block_length").cast("long").alias("block_length"),
                      F.col("label").cast("long").alias("label"))


def q_corpus_report(spark, sf_dir):
    out = stages.encode_raw_corpus(derive.raw_corpus(spark, sf_dir), _paired(spark, sf_dir))
    return stages.corpus_report(out)


def q_parse_records(spark, sf_dir):
    rows = io.parse_records(derive.record_lines(spark, sf_dir)).rows
    return rows.select(*_qid_cols(), "lang", "query")


def q_record_rejects(spark, sf_dir):
    return io.parse_records(derive.record_lines(spark, sf_dir)).rejects


def q_vector_rejects(spark, sf_dir):
    return io.parse_word_vectors(derive.vector_lines(spark, sf_dir), 2)[1]


def q_run_report(spark, sf_dir):
    folder = f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
    return stages.write_run(derive.raw_corpus(spark, sf_dir), _paired(spark, sf_dir), folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "filter_strict_python": _doc_rule(lambda c: text.filter_strict(c, "python")),
    "filter_strict_sql": _doc_rule(lambda c: text.filter_strict(c, "sql")),
    "filter_wide_python": _doc_rule(lambda c: text.filter_wide(c, "python")),
    "filter_wide_sql": _doc_rule(lambda c: text.filter_wide(c, "sql")),
    "contractions_python": _contractions("python"),
    "contractions_sql": _contractions("sql"),
    "squeeze_space_python": _doc_rule(lambda c: text.squeeze_space(c, "python")),
    "squeeze_space_sql": _doc_rule(lambda c: text.squeeze_space(c, "sql")),
    "snake_case": _doc_rule(text.snake_case),
    "strip_brackets_python": _doc_rule(lambda c: text.strip_brackets(c, "python")),
    "strip_brackets_sql": _doc_rule(lambda c: text.strip_brackets(c, "sql")),
    "strip_dots": _doc_rule(text.strip_dots),
    "split_words": _doc_rule(lambda c: text.split_words(c, unicode=True)),
    "tag_strings": _doc_rule(text.tag_strings),
    "tag_hex": _doc_rule(text.tag_hex),
    "tag_integers": _doc_rule(text.tag_integers),
    "tag_decimals": _doc_rule(text.tag_decimals),
    "tag_digit_words": _doc_rule(text.tag_digit_words),
    "lower_split": _doc_rule(lambda c: F.array_join(text.lower_split(c), "|")),
    "query_tokens_python": _doc_tokens(lambda c: text.query_tokens(c, "python")),
    "query_tokens_sql": _doc_tokens(lambda c: text.query_tokens(c, "sql")),
    "context_tokens_python": _doc_tokens(lambda c: text.context_tokens(c, "python")),
    "context_tokens_sql": _doc_tokens(lambda c: text.context_tokens(c, "sql")),
    "lemma_join": q_lemma_join,
    "lemma_pos_join": q_lemma_pos_join,
    "python_clean": q_python_clean,
    "python_vars": q_python_vars,
    "python_vars_all": q_python_vars_all,
    "python_code_tokens": q_python_code_tokens,
    "python_stored_names": q_python_stored_names,
    "python_lexemes": q_python_lexemes,
    "python_statement_tokens": q_python_statement_tokens,
    "sql_clean": q_sql_clean,
    "sql_sanitise": q_sql_sanitise,
    "sql_kinds": q_sql_kinds,
    "sql_from_region": q_sql_from_region,
    "sql_rename": q_sql_rename,
    "sql_string_patterns": q_sql_string_patterns,
    "subquery_count": q_subquery_count,
    "subquery_spans": q_subquery_spans,
    "sql_code_tokens": q_sql_code_tokens,
    "repl_flags": q_repl_flags,
    "repl_layout": q_repl_layout,
    "repl_repair": q_repl_repair,
    "repl_blocks": q_repl_blocks,
    "parse_records": q_parse_records,
    "record_rejects": q_record_rejects,
    "vector_rejects": q_vector_rejects,
    "flatten_record": q_flatten_record,
    "tokenise_corpus": q_tokenise_corpus,
    "candidate_counts": q_candidate_counts,
    "split_single": q_split_single,
    "split_multiple": q_split_multiple,
    "label_singles": q_label_singles,
    "count_value": q_count_value,
    "vocab_one": q_vocab_one,
    "vocab_union": q_vocab_union,
    "new_words": q_new_words,
    "roundtrip_diff": q_roundtrip_diff,
    "new_words_prefiltered": q_new_words_prefiltered,
    "roundtrip_diff_by_digest": q_roundtrip_diff_by_digest,
    "word_vectors": q_word_vectors,
    "unit_vectors": q_unit_vectors,
    "found_words": q_found_words,
    "failed_words": q_failed_words,
    "dictionary_numbering": q_dictionary_numbering,
    "append_numbering": q_append_numbering,
    "verify_dictionary": q_verify_dictionary,
    "lookup_ids": q_lookup_ids,
    "encode_text": q_encode_text,
    "fit_length": q_fit_length,
    "encode_code": q_encode_code,
    "encode_corpus": q_encode_corpus,
    "corpus_report": q_corpus_report,
    "run_report": q_run_report,
}
