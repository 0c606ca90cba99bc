"""Sources of one path from one scan, against each source read and normalised by itself."""

import pytest
from pyspark.sql import functions as F

from markforge.config import SourceSpec
from markforge.operators.normalize import normalize_pairs
from markforge.operators.union import union_sources
from markforge.plans.queries import q_source_counts, q_union_sources
from markforge.sources.readers import load_shared_pairs, load_sources

from conftest import SF001

COLS = "id long, part string, prompt string, title string, svg string, code string"
ROWS = [(1, "a", " p1 ", "t1", "<svg>1</svg>", None), (2, "a", None, "t2", "<SVG>2</SVG>", "<svg>c2</svg>"),
        (2, "a", None, "t2", "<SVG>2</SVG>", "<svg>c2</svg>"), (3, "b", "", "t3", "  ", "<svg>c3</svg>"),
        (4, "b", "p4", None, "text", None), (5, None, "p5", "t5", "<svg>5</svg>", None), (6, "c", "p6", " ", None, None),
        (None, "b", "p7", "t7", "<svg>7</svg>", "<svg>c7</svg>")]


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("shared") / "rows.parquet")
    spark.createDataFrame(ROWS, COLS).write.parquet(p)
    return p


def catalog(path):
    fields = {"prompt_fields": ("prompt", "title"), "markup_fields": ("svg", "code"), "split_column": "part"}
    return [SourceSpec("first", path=path, split="a", **fields), SourceSpec("second", path=path, split="b", **fields),
            SourceSpec("again", path=path, split="a", split_column="part", prompt_fields=("title",), markup_fields=("code", "svg")),
            SourceSpec("none", path=path, split="zz", **fields)]


def rows_of(df):
    return sorted(map(str, df.select("id", "prompt", "svg", "source_name").collect()))


def one_by_one(spark, specs):
    def prepare(df, spec):
        return normalize_pairs(df, spec.prompt_fields, spec.markup_fields, keep=["id"])

    return union_sources(load_sources(spark, specs, prepare)[0])


@pytest.mark.parametrize("whole", [False, True])
def test_same_rows_as_source_by_source(spark, path, whole):
    specs = catalog(path) + ([SourceSpec("whole", path=path, split=None, prompt_fields=("nothing", "title"))] if whole else [])
    got, skipped = load_shared_pairs(spark, specs, keep=["id"])
    assert not skipped
    assert rows_of(got) == rows_of(one_by_one(spark, specs))
    assert got.where("source_name = 'first' and id = 2").count() == 2  # repeated rows stay


def test_one_scan_with_the_splits_pushed(spark, path):
    got, _ = load_shared_pairs(spark, catalog(path), keep=["id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "part" in plan[plan.index("PushedFilters"):plan.index("ReadSchema")]
    for query in (q_union_sources, q_source_counts):
        assert query(spark, SF001)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_failures_stay_with_their_source(spark, path):
    specs = [*catalog(path), SourceSpec("gone", path=path + "-gone", split=None), SourceSpec("no split", path=path, split="train")]
    got, skipped = load_shared_pairs(spark, specs, keep=["id"])
    assert sorted(name for name, _ in skipped) == ["gone", "no split"]
    assert rows_of(got) == rows_of(one_by_one(spark, catalog(path)))
    assert load_shared_pairs(spark, specs[-2:-1])[0] is None


def test_csv_and_empty_tables(spark, path, tmp_path):
    spark.createDataFrame(ROWS, COLS).write.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    specs = [SourceSpec(s.name, path=str(tmp_path / "c"), format="csv", split=s.split, split_column="part",
                        prompt_fields=s.prompt_fields, markup_fields=s.markup_fields) for s in catalog(path)]
    got, skipped = load_shared_pairs(spark, specs, keep=["id"])
    want, _ = load_shared_pairs(spark, catalog(path), keep=["id"])
    assert not skipped and rows_of(got) == rows_of(want.withColumn("id", F.col("id").cast("string")))
    spark.read.parquet(path).limit(0).write.parquet(str(tmp_path / "e"))
    empty, skipped = load_shared_pairs(spark, catalog(str(tmp_path / "e")), keep=["id"])
    assert not skipped and empty.count() == 0
