"""Spark-native analytics for hit-level detector data.

Pulses are condensed into one row per (event, sensor), labelled with per-event
truth, selected, blended, described and audited -- all as DataFrame plans.
"""
