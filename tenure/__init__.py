"""tenure — effective-dated HR analytics as Spark DataFrame plans.

Layout:
  functions/  column-level helpers (Oracle-compatible string/number semantics,
              HR code mappings, text/template functions, similarity scorers)
  operators/  DataFrame operators (as-of picks, head counts, best match,
              field diffs, unique resolution, row expansion, roll-ups,
              similarity join)
  sources/    paste-text parsing, CSV/directory sources, keyed lookups, sinks,
              and the HR-shaped fixtures derived from the driver tables
  plans/      the composed jobs (bulk position change, transfers, hire
              staging, clinical report, refund split, name search, mail merge)
  streaming/  running a batch plan over a file stream with foreachBatch
"""

__version__ = "0.1.0"
