"""Markup fixtures derived from the driver's ``documents`` table.

No driver table holds SVG, so (prompt, markup) pairs, generation candidates
and test prompts are built from ``documents`` by ``doc_id`` arithmetic. Each
rule plants a known case (blank prompt, XML prolog, upper-case root,
truncation, element counts), so the expected verdicts follow from the id
alone; the DuckDB oracles in ``__spark_entry__`` state the same rules in SQL.
Whole document texts are used as prompts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markforge.session import spread

# Fixed fixture text.
XMLNS_VIEWBOX = ' xmlns="http://www.w3.org/2000/svg" viewBox="0 0 64 64">'
PATH_EL = '<path d="M0 0L9 9"/>'
CIRCLE_EL = '<circle r="3"/>'
RECT_EL = '<rect width="4" height="4"/>'
PROLOG = '<?xml version="1.0"?>'
PREAMBLE_SYSTEM = "system\nYou draw SVG.\nuser\n"
PREAMBLE_ASSISTANT = "\nassistant\n"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, spread over the cores when it is a single small split."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _mod(c: Column, m: int) -> Column:
    return F.pmod(c, F.lit(m))


def markup_body(m: Column) -> Column:
    """Element runs whose lengths follow ``m``: m%14 paths, m%11 circles, m%10 rects."""
    return F.concat(
        F.repeat(F.lit(PATH_EL), _mod(m, 14).cast("int")),
        F.repeat(F.lit(CIRCLE_EL), _mod(m, 11).cast("int")),
        F.repeat(F.lit(RECT_EL), _mod(m, 10).cast("int")),
    )


def markup_doc(m: Column, upper: Column, truncated: Column) -> Column:
    """Root open tag, body, then the matching close tag unless truncated."""
    tag = F.when(upper, F.lit("SVG")).otherwise(F.lit("svg"))
    close = F.when(truncated, F.lit("")).otherwise(F.concat(F.lit("</"), tag, F.lit(">")))
    return F.concat(F.lit("<"), tag, F.lit(XMLNS_VIEWBOX), markup_body(m), close)


def svg_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide-source pairs ``(doc_id, lang, source, caption, name, svg_code)``.

    caption: NULL if id%17=0; whitespace only if id%13=0; else the padded text.
    name (second prompt candidate): NULL if id%19=0.
    svg_code: XML prolog if id%7=0 (fails the prefix gate), else a blank
    lead; ``<SVG`` if id%11=0; no close tag if id%5=0; one trailing blank.
    """
    return svg_pairs_from(read_table(spark, sf_dir, "documents"))


def svg_pairs_from(d: DataFrame) -> DataFrame:
    """:func:`svg_pairs` over any frame with documents' columns."""
    i = F.col("doc_id")
    caption = (F.when(_mod(i, 17) == 0, F.lit(None).cast("string"))
               .when(_mod(i, 13) == 0, F.lit("\n \t"))
               .otherwise(F.concat(F.lit("  "), F.col("text"), F.lit("\n"))))
    name = F.when(_mod(i, 19) == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("alt "), F.col("lang"), F.lit(" "), F.col("source")))
    lead = F.when(_mod(i, 7) == 0, F.lit(PROLOG)).otherwise(F.lit("\n "))
    svg = F.concat(lead, markup_doc(i, _mod(i, 11) == 0, _mod(i, 5) == 0), F.lit(" "))
    return d.select("doc_id", "lang", "source", caption.alias("caption"), name.alias("name"),
                    svg.alias("svg_code"))


def candidates(spark: SparkSession, sf_dir: str, rounds: int = 2) -> DataFrame:
    """Generator output table ``(doc_id, round, raw)``: decoded text =
    preamble with the whole prompt + markup for ``doc_id + round``.

    Valid iff (doc_id+round)%5 <> 0, except that doc_id%23=0 truncates every
    round so the fallback is hit.
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    r = F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round")
    x = d.select("doc_id", "text", r)
    m = F.col("doc_id") + F.col("round")
    trunc = (_mod(m, 5) == 0) | (_mod(F.col("doc_id"), 23) == 0)
    raw = F.concat(F.lit(PREAMBLE_SYSTEM), F.coalesce(F.col("text"), F.lit("")), F.lit(PREAMBLE_ASSISTANT),
                   markup_doc(m, F.lit(False), trunc))
    return x.select("doc_id", F.col("round").cast("int").alias("round"), raw.alias("raw"))


def test_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test table ``(id, prompt)``: whole text; NULL when doc_id%17=0."""
    d = read_table(spark, sf_dir, "documents")
    prompt = F.when(_mod(F.col("doc_id"), 17) == 0, F.lit(None).cast("string")).otherwise(F.col("text"))
    return d.select(F.col("doc_id").alias("id"), prompt.alias("prompt"))


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, prompt, output): a user turn and the assistant turn
    right after it in the same conversation (a self-join on turn + 1, no
    window, so each conversation's turns need not meet in one task)."""
    c = read_table(spark, sf_dir, "conversations")
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    return u.join(a, ["conv_id", "turn"], "inner")


# --------------------------------------------------------------------------
# Validity fixture: eight root / closing variants by doc_id % 8 around the whole
# text, escaped, as a <desc>. The verdicts follow from the variant and from
# characters that XML does not allow at all.
# --------------------------------------------------------------------------

SVG_NS = "http://www.w3.org/2000/svg"
# (open tag, close tag, strict valid, suffix valid) per variant.
VALIDITY_VARIANTS = (
    (f'<svg xmlns="{SVG_NS}">', "</svg>", True, True),
    ("<SVG>", "</SVG>", False, False),
    ("<svg>", "", False, False),
    ("<mysvg>", "</mysvg>", False, True),
    (f'<s:svg xmlns:s="{SVG_NS}">', "</s:svg>", True, True),
    ("<svg>", "</svg>junk", False, False),
    ("<html>", "</html>", False, False),
    ('<?xml version="1.0"?><svg>', "</svg>", True, True),
)


def validity_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, markup) with the variant of ``doc_id % 8`` around shapes and the escaped text."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    v = _mod(F.col("doc_id"), len(VALIDITY_VARIANTS))
    opening = F.element_at(F.array(*[F.lit(o) for o, _, _, _ in VALIDITY_VARIANTS]), (v + 1).cast("int"))
    closing = F.element_at(F.array(*[F.lit(c) for _, c, _, _ in VALIDITY_VARIANTS]), (v + 1).cast("int"))
    text = F.coalesce(F.col("text"), F.lit(""))
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return d.select("doc_id", F.concat(opening, markup_body(F.col("doc_id")), F.lit("<desc>"), text, F.lit("</desc>"),
                                       closing).alias("markup"))


def markup_doc_py(m: int, upper: bool = False, truncated: bool = False) -> str:
    """Python twin of :func:`markup_doc` (for stub generators and tests)."""
    tag = "SVG" if upper else "svg"
    body = PATH_EL * (m % 14) + CIRCLE_EL * (m % 11) + RECT_EL * (m % 10)
    return f"<{tag}{XMLNS_VIEWBOX}{body}" + ("" if truncated else f"</{tag}>")


def stub_generator(pdf, spec):
    """Deterministic stand-in for a model: the decoded text of the candidate
    fixture for (id, round), i.e. prompt preamble + markup, truncated when
    (id+round)%5=0 or id%23=0."""
    out = []
    for i, prompt, rnd in zip(pdf["id"], pdf["prompt"], pdf["round"]):
        m = int(i) + int(rnd)
        trunc = m % 5 == 0 or int(i) % 23 == 0
        out.append(PREAMBLE_SYSTEM + (prompt or "") + PREAMBLE_ASSISTANT + markup_doc_py(m, False, trunc))
    return out


def later_rounds_generator(pdf, spec):
    """:func:`stub_generator` for rounds after the first; a row of the first one is an error."""
    if (pdf["round"] == 1).any():
        raise ValueError("round 1 is committed and must not be generated again")
    return stub_generator(pdf, spec)
