"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywood.llm.collocations import OP13_SQL, op13_collocations
from tallywood.llm.exact_dedup import OP9_SQL, op9_exact_copies
from tallywood.llm.langid import op4_byte_network
from tallywood.llm.linededup import OP5_SQL, op5_line_runs
from tallywood.llm.lm import op6_interpolation
from tallywood.llm.mixing import op10_mix_sources
from tallywood.llm.oddsketch import op12_odd_sketches
from tallywood.llm.packing import op1_length_buckets
from tallywood.llm.partenum import op7_partenum_join
from tallywood.llm.periodic import op11_periodic_runs
from tallywood.llm.quality import op8_quality_rules
from tallywood.llm.sharding import op3_byte_shards
from tallywood.llm.warc import OP2_SQL, op2_warc_segments

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_length_buckets": op1_length_buckets,
    "op2_warc_segments": op2_warc_segments,
    "op3_byte_shards": op3_byte_shards,
    "op4_byte_network": op4_byte_network,
    "op5_line_runs": op5_line_runs,
    "op6_interpolation": op6_interpolation,
    "op7_partenum_join": op7_partenum_join,
    "op8_quality_rules": op8_quality_rules,
    "op9_exact_copies": op9_exact_copies,
    "op10_mix_sources": op10_mix_sources,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_odd_sketches": op12_odd_sketches,
    "op13_collocations": op13_collocations,
}
ORACLES: dict[str, str] = {
    "op2_warc_segments": OP2_SQL,
    "op5_line_runs": OP5_SQL,
    "op9_exact_copies": OP9_SQL,
    "op13_collocations": OP13_SQL,
}
