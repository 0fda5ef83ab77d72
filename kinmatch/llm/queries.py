"""The subpackage's queries and the SQL that checks them, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinmatch.llm.chain import chain_query
from kinmatch.llm.chat import CHAT_SQL, chat_query
from kinmatch.llm.decontaminate import CONTAMINATION_SQL, contamination_query
from kinmatch.llm.html_main import html_query
from kinmatch.llm.langid import langid_query
from kinmatch.llm.media import media_query
from kinmatch.llm.packing import packing_query
from kinmatch.llm.prefix_free import prefix_free_query
from kinmatch.llm.simhash import simhash_query
from kinmatch.llm.warc import WARC_SQL, warc_query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": warc_query,
        "op2_chat": chat_query,
        "op3_chain": chain_query,
        "op4_decontaminate": contamination_query,
        "op5_media": media_query,
        "op6_packing": packing_query,
        "op7_simhash": simhash_query,
        "op8_prefix_free": prefix_free_query,
        "op9_langid": langid_query,
        "op10_html": html_query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": WARC_SQL, "op2_chat": CHAT_SQL, "op4_decontaminate": CONTAMINATION_SQL}
