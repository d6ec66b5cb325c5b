"""cartwheel — product & payment analytics as plain Spark DataFrame jobs.

Every job is a function ``DataFrame(s) -> DataFrame``; ``cartwheel.plans``
wires them into the warehouse layers (landing -> staging -> intermediate ->
core facts/dims -> metrics) and materialises the reuse points.
"""

__version__ = "0.1.0"
