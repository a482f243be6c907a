"""Queries over the test tables, each with the SQL that gives the same answer.

A module contributes ``QUERIES`` (name → function of session and table directory) and ``ORACLES`` (name → SQL).
"""
