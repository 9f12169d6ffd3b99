"""freqscope: approximate frequency analytics as Spark DataFrame jobs.

Sketches are ordinary long-format tables of cells, so building one is a
grouped sum that Catalyst plans with partial aggregation, and reading one is an
equi-join followed by a grouped min/median.
"""

__version__ = "0.1.0"
