"""Training-data operators: near-duplicates, quality, PII, licences, decontamination, HTML, tokenizers, chat.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
