"""The corpus pipeline: each stage applies one operator of ``tripflow.llm`` to the whole of what
its predecessor kept.  ``STAGES`` lists them; ``run(spark, sf_dir)`` applies them to ``documents``."""

from __future__ import annotations

from tripflow.llm.stages import STAGES, run

#: SQL cannot express the stages (hashing, tokenizing, training); they are tested against brute force.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]
