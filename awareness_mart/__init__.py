"""Security-awareness data mart on Spark: staging, change tracking, facts, reports."""
