"""gridloom: harmonise, type, compare and reconcile repeatedly published tabular releases on Spark."""
