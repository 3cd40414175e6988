"""Which side a read goes to while a collection is moved."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("shadow", "ramp", "done")


@dataclass
class Cutover:
    """shadow: the source answers, the target is compared. ramp: a share of reads goes to the target. done: all do."""

    mode: str = "shadow"
    target_read_pct: float = 0.0
    note: str = ""

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {', '.join(MODES)}")
        if not 0 <= self.target_read_pct <= 100:
            raise ValueError("target_read_pct must lie between 0 and 100")

    @classmethod
    def load(cls, path: str) -> Cutover:
        """The state in a file; the default one if there is none."""
        try:
            found = json.loads(Path(path).read_text())
        except FileNotFoundError:
            return cls()
        if unknown := sorted(found.keys() - {f.name for f in fields(cls)}):
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        return cls(**found)

    def reload(self, path: str) -> Cutover:
        """Takes over what the file says now, so a router that holds this state follows it; a bad file changes nothing."""
        self.__dict__.update(asdict(Cutover.load(path)))
        return self

    def save(self, path: str) -> None:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(json.dumps(asdict(self)))

    def moved(self, mode: str | None = None, pct: float | None = None, note: str | None = None) -> Cutover:
        """A share without a mode means ramp; a share of 0 is the way back."""
        if mode is None and pct is not None:
            mode = "ramp"
        return Cutover(mode or self.mode, self.target_read_pct if pct is None else pct, self.note if note is None else note)


def bucket(query_id: Column) -> Column:
    """A number from 0 to below 100 for each query: the same one each time it is asked."""
    return F.pmod(query_id.cast("long") * 7919, F.lit(10007)) * 100.0 / 10007


def routed(queries: DataFrame, state: Cutover, text: bool = False) -> DataFrame:
    """Adds route (source or target) and compared. Text queries only the target can answer."""
    if text or state.mode == "done":
        route: Column = F.lit("target")
    elif state.mode == "ramp":
        route = F.when(bucket(F.col("query_id")) < state.target_read_pct, "target").otherwise("source")
    else:
        route = F.lit("source")
    return queries.withColumn("route", route).withColumn("compared", F.lit(state.mode == "shadow" and not text))


def shadow_diffs(source_hits: DataFrame, target_hits: DataFrame) -> DataFrame:
    """(query_id, differs): whether the sets of ids differ, in whatever order they rank."""
    marked = source_hits.select("query_id", "id", F.lit(1).alias("s")).unionAll(target_hits.select("query_id", "id", F.lit(2).alias("s")))
    each = marked.distinct().groupBy("query_id", "id").agg(F.sum("s").alias("s"))
    return each.groupBy("query_id").agg((F.max(F.when(F.col("s") < 3, 1).otherwise(0)) == 1).alias("differs"))


def router_stats(routes: DataFrame, diffs: DataFrame | None = None) -> DataFrame:
    """One row: source_reads, target_reads, comparisons, diffs, diff_rate."""
    known = routes if diffs is None else routes.join(diffs, "query_id", "left")
    differs = F.lit(False) if diffs is None else F.coalesce(F.col("differs"), F.lit(False))
    one = known.agg(F.count_if(F.col("route") == "source").alias("source_reads"), F.count_if(F.col("route") == "target").alias("target_reads"), F.count_if("compared").alias("comparisons"), F.count_if(F.col("compared") & differs).alias("diffs"))
    return one.withColumn("diff_rate", F.when(F.col("comparisons") > 0, F.col("diffs") / F.col("comparisons")).otherwise(F.lit(0.0)))
