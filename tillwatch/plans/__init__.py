"""Compositions: the sales transformation, the detection chain, reports and the daily job."""
