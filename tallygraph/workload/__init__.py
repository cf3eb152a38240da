"""The registered queries over the test tables, and the SQL each must agree with."""

from tallygraph.workload.oracles import ORACLES
from tallygraph.workload.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
