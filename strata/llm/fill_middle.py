"""Fill-in-middle transformation of whole texts, in built-in expressions alone.

A text is cut into ``n`` units (``regexp_count``).  Two cut points per row give
a pattern of its own, ``\\A(unit{a})(unit{b-a})(rest)\\z`` with possessive
quantifiers, so one match captures prefix, middle and suffix, and one
``regexp_replace`` writes them in the order of the row's form.  A possessive
group repeats in a loop (no recursion, no backtracking), so a text of millions
of units needs no deep stack.

``transform`` returns the examples, ``restore`` rebuilds the text from output
and form.  Everything is one projection over the scan: no shuffle, no Python.

Edge cases: a null or empty text is plain (null counts as empty); a text that
holds one of the marks is plain; a null id is drawn like the empty string;
repeated rows give equal rows; an empty table gives an empty result; other
input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = r"[^\n]*+\n|[^\n]++"


@dataclass(frozen=True)
class Marks:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.all
        if len(set(marks)) < 3 or "" in marks:
            raise ValueError(f"marks must be three different strings, not {marks}")
        for a in marks:
            for b in marks:
                # a mark's end that begins another one, or a mark inside another
                shared = range(1, min(len(a), len(b)) + 1) if a != b else range(1, len(a))
                if any(a.endswith(b[:k]) for k in shared) or (a != b and a in b):
                    raise ValueError(f"{a!r} and {b!r} overlap, outputs could not be read back")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def draws(doc_id: Column, seed: int = 7) -> list[Column]:
    """Four unsigned 32-bit draws from the id: the first hex groups of a sha256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def _replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def transform(docs: DataFrame, unit: str = LINES, seed: int = 7, fim_percent: int = 100, spm_percent: int = 50,
              marks: Marks = Marks()) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm) and output of every text.

    ``unit`` is a Java pattern whose matches, one after the other, cover any
    text; its parts should be possessive, as in ``LINES``."""
    p, s, m = (_replacement(x) for x in marks.all)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", F.regexp_count("text", F.lit(unit)).cast("long").alias("n"),
        *[h.alias(f"h{k}") for k, h in enumerate(draws(F.col("doc_id"), seed), 1)])
    marked = F.lit(False)
    for mark in marks.all:
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= fim_percent)
    first, second = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    rows = rows.select(
        "doc_id", "text", "n",
        F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
        F.least(first, second).alias("a"), F.greatest(first, second).alias("b"))
    pattern = F.format_string(rf"\A((?:{unit.replace('%', '%%')}){{%d}}+)((?:{unit.replace('%', '%%')}){{%d}}+)([\s\S]*+)\z",
                              F.col("a"), F.col("b") - F.col("a"))
    order = F.when(F.col("form") == "psm", f"{p}$1{s}$3{m}$2").otherwise(f"{s}$3{p}$1{m}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return rows.select("doc_id", "n", "form", output.alias("output"))


def parts(marks: Marks = Marks()) -> tuple[Column, Column, Column]:
    """(prefix, middle, suffix) read back from ``output`` and ``form``; null for
    plain rows.  No mark occurs inside a part, so each is found by its marks."""
    out, psm, form = F.col("output"), F.col("form") == "psm", F.col("form")

    def between(left: str, right: str) -> Column:
        return F.substring_index(F.substring_index(out, left, -1), right, 1)

    prefix = F.when(psm, between(marks.prefix, marks.suffix)).when(form == "spm", between(marks.prefix, marks.middle))
    suffix = F.when(psm, between(marks.suffix, marks.middle)).when(form == "spm", between(marks.suffix, marks.prefix))
    middle = F.when(form != "plain", F.substring_index(out, marks.middle, -1))
    return prefix, middle, suffix


def restore(examples: DataFrame, marks: Marks = Marks()) -> DataFrame:
    """The examples with ``prefix``, ``middle``, ``suffix`` and the ``restored`` text."""
    cut = examples.withColumns(dict(zip(("prefix", "middle", "suffix"), parts(marks))))
    return cut.withColumn("restored", F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat("prefix", "middle", "suffix")))


def digest(examples: DataFrame, marks: Marks = Marks()) -> DataFrame:
    """Counts and hashes of the examples, with the text rebuilt from them."""

    def sha(name):
        return F.sha2(F.col(name).cast("binary"), 256)

    return restore(examples, marks).select(
        "doc_id", "n", "form", F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"),
        sha("output").alias("output_sha256"), sha("restored").alias("restored_sha256"))
