"""adtrail: channel performance analytics on Spark.

Reads per-channel ad, email, web and revenue exports, maps them to one
typed fact schema, stacks them, joins the client dimension, derives CTR /
CPC / CPM / interactions, attributes daily channel revenue and answers
report and exploration queries -- all as DataFrame plans.
"""

__version__ = "0.1.0"
