"""sunlight: disclosure-and-spending analytics as Spark DataFrame jobs.

Payments declared by companies to professionals are cleaned, linked to
reimbursed product sales through a product catalogue, and rolled up into
spend / sales / share / return-on-spend marts plus a ranked recipient search.

Sub-packages
------------
sources    readers (CSV with drifting headers, Latin-1 TSV, geo points) and
           the fixed reference dimensions
functions  Column-expression builders (number dialects, postal codes, name
           normaliser, grouping rules, report formatting)
operators  reusable DataFrame operators (top-k, top-k per group, ranked
           string aggregation, group-max lookup, schema profile)
plans      mart builders and user-facing queries
sinks      Parquet / JSON writers
streaming  the staging step run incrementally over a file stream
"""

__version__ = "0.1.0"
