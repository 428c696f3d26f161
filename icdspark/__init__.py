"""icdspark: clinical-note multilabel analytics as lazy Spark DataFrame operators.

Sub-packages
------------
sources    readers/writers (CSV bronze ingest, Parquet, word-vector files) and the
           proxy views that stand in for the clinical tables on the test data
functions  Column -> Column expressions (text cleaning, code dotting, arrays, maths)
operators  DataFrame -> DataFrame operators (cohort, split, features, metrics, ROC,
           embeddings, model) plus the scalable running-total primitive
plans      composed jobs (labelled admissions, encoding, evaluation report) and the
           query registry used by ``__spark_entry__``
streaming  the stateless note operators applied to a Structured Streaming source
"""

__version__ = "0.1.0"
