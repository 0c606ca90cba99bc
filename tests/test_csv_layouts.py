"""Files of one CSV path whose headers differ."""

import gzip

import pytest

from markforge.config import SourceSpec
from markforge.sources.readers import read_csv_text, read_pairs_csv, read_source, read_test_prompts


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "two words" / "lang=en"
    d.mkdir(parents=True)
    (d / "a.csv").write_text('prompt,svg\nred,"<svg a=""1"">\n</svg>"\nnan,<svg>1</svg>\n', encoding="utf-8")
    (d / "b é.csv").write_text('﻿\r\n"extra\nname",svg,"prompt"\r\n9,<svg>2</svg>,blue\r\n', encoding="utf-8")
    (d / "c.csv").write_text("svg,prompt\n<svg>3</svg>,green\n<svg>4</svg>,grey\n", encoding="utf-8")
    (d / "empty.csv").write_text("")
    with gzip.open(d / "d.csv.gz", "wt") as f:
        f.write("x,x,,prompt,svg\n1,2,3,black,<svg>5</svg>\n")
    return tmp_path


WANT = [("red", '<svg a="1">\n</svg>'), (None, "<svg>1</svg>"), ("blue", "<svg>2</svg>"), ("green", "<svg>3</svg>"),
        ("grey", "<svg>4</svg>"), ("black", "<svg>5</svg>")]


def test_fields_by_each_files_header(spark, folder):
    got = read_pairs_csv(spark, f"{folder}/two words*/*").collect()
    assert sorted(map(tuple, got), key=str) == sorted(WANT, key=str)
    with pytest.raises(ValueError):
        read_csv_text(spark, f"{folder}/two words*/*", ["svg"], one_of=[["extra\nname"]])


def test_file_order_over_layouts(spark, folder):
    spec = SourceSpec("s", path=f"{folder}/two words*/*", format="csv", split=None, prompt_fields=("prompt",), markup_fields=("svg",))
    got = read_source(spark, spec, with_position=True).orderBy("input_pos").select("prompt", "svg").collect()
    assert list(map(tuple, got)) == WANT
    assert read_source(spark, spec).count() == 6
    ids = read_test_prompts(spark, f"{folder}/two words*/*", id_col="svg", with_position=True).orderBy("input_pos").collect()
    assert [r.svg for r in ids] == [s for _, s in WANT]
