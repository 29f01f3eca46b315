"""Queries of the library over the driver's tables, one for each operator."""

from . import amplicons, annotations, files, genotypes, repertoires, scalars
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "amplicons", "annotations", "files", "genotypes", "repertoires", "scalars"]
