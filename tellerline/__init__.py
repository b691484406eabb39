"""Staged JSON -> bronze -> silver -> gold pipelines on plain Spark.

Sub-packages:

* ``functions``  column expressions (stamps, change tests, window predicates)
* ``operators``  DataFrame -> DataFrame operators (dedupe, merges, history)
* ``plans``      gold summary plans and the jobs that store them
* ``sources``    staged files, layer tables, publishing, run log
* ``streaming``  stage -> bronze and bronze -> silver jobs
* ``registry``   the queries run over the driver tables, with their SQL twins
"""
