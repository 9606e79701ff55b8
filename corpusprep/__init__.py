"""corpusprep: question / context / code corpus preparation on Spark.

Column rules live in ``corpusprep.functions`` (Column -> Column), DataFrame jobs in
``corpusprep.operators`` (DataFrame -> DataFrame), readers and writers in
``corpusprep.sources``, composite stages in ``corpusprep.plans`` and the streaming
variant of the stateless rules in ``corpusprep.streaming``.
"""

__version__ = "0.1.0"
