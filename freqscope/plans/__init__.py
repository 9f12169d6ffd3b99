"""Query plans: parameterised jobs composed from sources and operators."""
