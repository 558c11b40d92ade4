"""Declarations of a data product and the jobs that run one."""
