"""Training-data operators: deduplication, decontamination, classifiers, tokenizers, WARC.

Every operator takes and returns DataFrames. Spark reads, shuffles and writes the rows; inside
the tasks numpy works on Arrow batches (``textcore``). Nothing else in the library imports
this package.
"""
