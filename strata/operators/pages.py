"""Batch page conversion as a DataFrame job.

A manifest (slug, accent, accent2) drives the job: each slug is left-joined
to its source page, the title and body are cut out with regular expressions,
placeholders of a head template are filled literally, and a status says
whether the page was created, had no body, or was not found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Extraction patterns (title: case-insensitive, first match on
# one line; body: case-insensitive, dot matches newline, greedy).
TITLE_PATTERN = r"(?i)<title>(.*?)</title>"
BODY_PATTERN = r"(?is)<body[^>]*>(.*)</body>"

# Template placeholders, in substitution order.
PLACEHOLDERS = ["%%TITLE%%", "%%ACCENT%%", "%%ACCENT2%%", "%%ACCENT_ENC%%", "%%SLUG%%"]

# Closing text appended after the body.
PAGE_TAIL = "\n</body>\n</html>"

# Accent colour pairs (primary, secondary) of the page theme.
ACCENT_PALETTE = [
    ("#2563eb", "#3b82f6"),
    ("#059669", "#10b981"),
    ("#dc2626", "#ef4444"),
    ("#7c3aed", "#8b5cf6"),
    ("#d97706", "#f59e0b"),
    ("#0d9488", "#14b8a6"),
]


# Each pattern is evaluated once per page: the whole match (group 0) is
# extracted, a non-empty match means "found" (a match always contains its
# tags), and the captured text is cut out with plain string functions.
_TITLE_OPEN, _TITLE_CLOSE = len("<title>"), len("</title>")
_BODY_CLOSE = len("</body>")


def title_match(html: Column) -> Column:
    return F.regexp_extract(html, TITLE_PATTERN, 0)


def body_match(html: Column) -> Column:
    return F.regexp_extract(html, BODY_PATTERN, 0)


def page_title(match: Column, fallback: Column) -> Column:
    """Title text of a title match, or ``fallback`` when there was none."""
    text = F.substr(match, F.lit(_TITLE_OPEN + 1), F.length(match) - _TITLE_OPEN - _TITLE_CLOSE)
    return F.when(F.coalesce(match, F.lit("")) != "", text).otherwise(fallback)


def has_body(match: Column) -> Column:
    return F.coalesce(match, F.lit("")) != ""


def page_body(match: Column) -> Column:
    """Text between the opening body tag (which ends at the first '>', as the
    tag pattern excludes '>') and the closing tag that ends the match."""
    start = F.instr(match, ">") + 1
    return F.coalesce(F.substr(match, start, F.length(match) - start + 1 - _BODY_CLOSE), F.lit(""))


def palette_manifest(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Manifest for every page: slug = page id, accents by ``id % len(palette)``."""
    idx = F.pmod(F.col(id_col), F.lit(len(ACCENT_PALETTE)))
    accent = F.element_at(F.array(*[F.lit(a) for a, _ in ACCENT_PALETTE]), (idx + 1).cast("int"))
    accent2 = F.element_at(F.array(*[F.lit(b) for _, b in ACCENT_PALETTE]), (idx + 1).cast("int"))
    return pages.select(F.col(id_col).alias("slug"), accent.alias("accent"), accent2.alias("accent2"))


def extract_pages(manifest: DataFrame, pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Manifest left-joined to pages with title, body flag, body and status."""
    src = pages.select(
        F.col(id_col).alias("_pid"),
        title_match(F.col(html_col)).alias("_tm"),
        body_match(F.col(html_col)).alias("_bm"),
    )
    joined = manifest.join(src, manifest["slug"] == src["_pid"], "left")
    found = has_body(F.col("_bm"))
    return joined.select(
        "slug", "accent", "accent2",
        F.col("_pid").alias("page_id"),
        page_title(F.col("_tm"), F.col("slug").cast("string")).alias("title"),
        found.alias("has_body"),
        page_body(F.col("_bm")).alias("body"),
        F.when(F.col("_pid").isNull(), F.lit("SOURCE_NOT_FOUND"))
        .when(~found, F.lit("NO_BODY"))
        .otherwise(F.lit("CREATED"))
        .alias("status"),
    )


def render_pages(extracted: DataFrame, template: str) -> DataFrame:
    """Filled page text for created pages: (slug, page)."""
    values = [
        F.col("title"),
        F.col("accent"),
        F.col("accent2"),
        F.replace(F.col("accent"), F.lit("#"), F.lit("%23")),
        F.col("slug").cast("string"),
    ]
    head: Column = F.lit(template)
    for placeholder, value in zip(PLACEHOLDERS, values):
        head = F.replace(head, F.lit(placeholder), value)
    return extracted.where(F.col("status") == "CREATED").select(
        "slug", F.concat(head, F.col("body"), F.lit(PAGE_TAIL)).alias("page")
    )
