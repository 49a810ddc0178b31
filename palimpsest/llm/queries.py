"""The subpackage's queries and their DuckDB SQL, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import chat_format, decontaminate, host_rules, license_scan, mixing, simhash, token_files, toxicity, url_filter, warc_zip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": chat_format.op1_chat_format,
    "op2_simhash": simhash.op2_simhash,
    "op3_mixing": mixing.op3_mixing,
    "op4_token_files": token_files.op4_token_files,
    "op5_warc_zip": warc_zip.op5_warc_zip,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_host_rules": host_rules.op8_host_rules,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_url_filter": url_filter.op10_url_filter,
    # What SQL can tell of two of them.
    "mix_targets": mixing.mix_targets,
    "url_rules": url_filter.url_rules,
}

SQL: dict[str, str] = {
    "op1_chat_format": chat_format.OP1_SQL,
    "op5_warc_zip": warc_zip.OP5_SQL,
    "op8_host_rules": host_rules.OP8_SQL,
    "mix_targets": mixing.MIX_SQL,
    "url_rules": url_filter.URL_SQL,
}
