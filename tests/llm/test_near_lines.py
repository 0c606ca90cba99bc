"""Lines of five words and more within one word edit of an earlier line are removed."""

import random

from markforge.llm import op2


def test_near_lines_of_five_words(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice("abcd") for _ in range(rnd.randrange(3, 10)))) for i in range(60)]
    rows += [(60, "one two three four five"), (61, "one two 3 four five"), (62, "one two three four five six"),
             (63, "u v w x"), (64, "u v w z"), (65, "u v w x y")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    seen, want = [], {}
    for i, text in rows:
        line = text.split()
        near = len(line) >= 5 and any(len(x) >= 5 and op2.within_one_edit(line, x) for x in seen)
        want[i] = int(line in seen or near)
        seen.append(line)
    got = {r.doc_id: r.n_removed for r in op2.op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == want and (got[61], got[62], got[64], got[65]) == (1, 1, 0, 0)
