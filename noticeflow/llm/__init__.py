"""Operators for large-scale training-data preparation.

One module per operator; :mod:`noticeflow.llm.queries` registers one query
for each. Nothing outside this folder imports it except the entry file
(which adds the queries when the folder is there) and ``corpus_pipeline.py``.
"""
