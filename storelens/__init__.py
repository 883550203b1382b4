"""storelens: retail-warehouse analytics and question-log jobs on PySpark.

Every public function takes DataFrames and returns a DataFrame; nothing keeps
session state.  See README.md for the map from operator to module.
"""
