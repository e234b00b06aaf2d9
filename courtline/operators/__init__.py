"""Relational operators of the pipeline, as DataFrame plans.

conform  - typed projections, null fills, date parsing, schema checks
split    - season list, cutoff date, current / past split
combine  - positional and by-name unions
merge    - keyed incremental merge, partitioned and clustered layout
reports  - load reports and dashboard tables
"""
