"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from storelens.llm import (
    interaction, linededup, merkle, mixing, packing, preference, quality, secrets, simhash, topk, urlfilter,
    vptree, warc,
)


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


ENTRIES: dict[str, Entry] = {
    "op1_line_dedup": Entry(linededup.op1_line_dedup, linededup.OP1_SQL),
    "op2_simhash": Entry(simhash.op2_simhash),
    "op3_best_fit_packing": Entry(packing.op3_best_fit_packing),
    "op4_top_k": Entry(topk.op4_top_k, topk.OP4_SQL),
    "op5_mix_sources": Entry(mixing.op5_mix_sources),
    "op6_url_filter": Entry(urlfilter.op6_url_filter, urlfilter.OP6_SQL),
    "op7_quality_rules": Entry(quality.op7_quality_rules),
    "op8_chat_preferences": Entry(preference.op8_chat_preferences, preference.OP8_SQL),
    "op9_warc": Entry(warc.op9_warc, warc.OP9_SQL),
    "op10_secret_scan": Entry(secrets.op10_secret_scan),
    "op11_merkle_manifest": Entry(merkle.op11_merkle_manifest, merkle.OP11_SQL),
    "op12_vp_nearest": Entry(vptree.op12_vp_nearest),
    "op13_filter_audit": Entry(interaction.op13_filter_audit, interaction.OP13_SQL),
}
