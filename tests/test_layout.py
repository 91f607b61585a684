"""The optional subpackage stays optional, and stage tables behave."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from siftwise.plans.stages import broadcast_if_small, drop_stage, save_stage, shared_dir

ROOT = Path(__file__).resolve().parent.parent


def test_nothing_else_imports_the_optional_subpackage():
    for file in (ROOT / "siftwise").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert not re.search(r"^\s*(from|import)\s+siftwise\.llm|from siftwise import llm", file.read_text(), re.M), file


def test_stage_tables(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")
    stage = save_stage(spark.range(5), "t")
    assert stage.count() == 5 and "Range" not in stage._jdf.queryExecution().toString()
    drop_stage(stage)
    assert not Path(stage._stage_path.removeprefix("file://")).exists()
    assert save_stage(spark.range(0), "none").count() == 0


def test_broadcast_is_size_checked(spark):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_small(spark.range(10), 10)) and not hinted(broadcast_if_small(spark.range(11), 10))
    wide = lambda: spark.range(10).select(F.repeat(F.lit("x"), 100).alias("x"))
    assert hinted(broadcast_if_small(wide(), 10, F.length("x"), 1000)) and not hinted(broadcast_if_small(wide(), 10, F.length("x"), 999))
    assert hinted(broadcast_if_small(wide().limit(0), 10, F.length("x"), 0))
