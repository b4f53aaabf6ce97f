"""millrace: supervised-learning data work on Spark tables.

Sub-packages
------------
sources    reading CSV and image folders, file listings, SQL views, model files
functions  column expressions (sentinels, labels, class names, response parsing)
operators  table operators (profiling, splits, encoding, models, evaluation, tuning, runs)
plans      the registered queries with their SQL twins
"""
