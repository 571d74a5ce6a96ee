"""Whole jobs: operators composed into the tables the business asks for.

A plan is a function from DataFrames and parameters (run date, thresholds) to a
DataFrame; sources and sinks stay with the caller, so each job is one action.
"""
