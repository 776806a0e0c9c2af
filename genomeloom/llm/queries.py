"""Queries of this subpackage: name -> (runner, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audit, chat, exact, lines, mixing, near, packing, phrases, ppm, quality, shard, urls, warc
from .common import table

Runner = Callable[[SparkSession, str], DataFrame]


def _over(*names: str, of: Callable[..., DataFrame]) -> Runner:
    return lambda spark, sf_dir: of(*[table(spark, sf_dir, n) for n in names])


ENTRIES: dict[str, tuple[Runner, str | None]] = {
    "op1_temperature_mix": (_over("documents", of=mixing.op1_temperature_mix), None),
    "op2_hypergeometric_shards": (_over("documents", of=shard.op2_hypergeometric_shards), None),
    "op3_winnowed_lines": (_over("documents", of=lines.op3_winnowed_lines), None),
    "op4_planned_best_fit": (_over("documents", of=packing.op4_planned_best_fit), None),
    "op5_linked_tool_calls": (_over("conversations", of=chat.op5_linked_tool_calls), None),
    "op6_partial_matching": (_over("documents", of=ppm.op6_partial_matching), None),
    "op7_certified_cutoffs": (_over("documents", "labels", of=quality.op7_certified_cutoffs), quality.SQL),
    "op8_order_minhash": (_over("documents", of=near.op8_order_minhash), None),
    "op9_heavy_hitter_dedup": (_over("documents", of=exact.op9_heavy_hitter_dedup), exact.SQL),
    "op10_derived_records": (_over("pages", of=warc.op10_derived_records), None),
    "op11_collocations": (_over("documents", of=phrases.op11_collocations), phrases.SQL),
    "op12_filter_audit": (_over("documents", "labels", of=audit.op12_filter_audit), audit.SQL),
    "op13_url_filter": (_over("pages", of=urls.op13_url_filter), urls.SQL),
}


def queries() -> dict[str, Runner]:
    return {name: run for name, (run, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql}
