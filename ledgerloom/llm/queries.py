"""The numbered operators as queries over the driver's tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import chat, collocations, decontam, fim, html, langid, media, packing, pii, sharding, simhash, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": lambda s, d: warc.op1_warc(_table(s, d, "pages")),
        "op2_media": lambda s, d: media.op2_media(_table(s, d, "documents")),
        "op3_pii": lambda s, d: pii.op3_pii(_table(s, d, "documents")),
        "op4_simhash": lambda s, d: simhash.op4_simhash(_table(s, d, "documents")),
        "op5_langid": lambda s, d: langid.op5_langid(_table(s, d, "pages"), _table(s, d, "documents")),
        "op6_packing": lambda s, d: packing.op6_packing(_table(s, d, "documents")),
        "op7_decontamination": lambda s, d: decontam.op7_decontamination(_table(s, d, "documents"), _table(s, d, "benchmark")),
        "op8_html": lambda s, d: html.op8_html(_table(s, d, "pages")),
        "op9_chat": lambda s, d: chat.op9_chat(_table(s, d, "conversations")),
        "op10_toxicity": lambda s, d: toxicity.op10_toxicity(_table(s, d, "documents"), _table(s, d, "labels")),
        "op11_collocations": lambda s, d: collocations.op11_collocations(_table(s, d, "documents")),
        "op12_fim": lambda s, d: fim.op12_fim(_table(s, d, "documents")),
        "op13_sharding": lambda s, d: sharding.op13_sharding(_table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": warc.OP1_SQL, "op7_decontamination": decontam.OP7_SQL, "op9_chat": chat.OP9_SQL, "op11_collocations": collocations.OP11_SQL, "op12_fim": fim.OP12_SQL}
