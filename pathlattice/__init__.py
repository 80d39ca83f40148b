"""pathlattice: k-shortest-path analytics over changing weighted graphs, on Spark.

Layout
  sources/     table and stream readers (trip CSV, graph snapshots, message streams)
  functions/   column-expression codecs (edge / query / result messages, map geometry)
  operators/   DataFrame operators (graph building, upserts, search steps, re-weighting, layers)
  plans/       multi-step plans (the bounded bidirectional k-best search loop)
  streaming/   Structured Streaming wiring around the batch operators
"""

from pathlattice.session import build_session, checkpoint_base, scratch_path

__all__ = ["build_session", "checkpoint_base", "scratch_path"]
