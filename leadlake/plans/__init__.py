"""The seven jobs as plans (DataFrames in, DataFrame out) and runners.

Import from the modules: ``lead_flat``, ``comm_logs``, ``lead_360``, ``engagement``,
``response`` (plans), ``jobs`` (read / plan / write runners), ``testbed`` /
``catalogue`` / ``oracle`` (the queries over the driver's test tables).
"""
