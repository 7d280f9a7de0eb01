"""Readable text of a web page, computed row by row (no shuffle).

Rules: comments and noise elements go first. The body text is taken from the container element
(div, article, section, main) with the most paragraphs; on equal counts the earliest one wins. A
container holds at least the paragraphs of any container inside it and opens before it, so only
outermost containers can win, and one running depth is all the parsing needed. When no container
has a paragraph, the whole page counts. Paragraphs longer than 40 characters are kept, in order,
separated by an empty line. An unclosed noise element is left in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.barrier import let, with_computed
from newsloom.functions.text import TAG, decode_collapsed

# Elements that never hold body text.
NOISE_TAGS = (
    "script", "style", "noscript", "nav", "footer", "header",
    "aside", "form", "button", "iframe", "svg", "figure",
)
CONTAINER_TAGS = ("div", "article", "section", "main")
MIN_PARAGRAPH_CHARS = 40

_MARK = "\x01"
_COMMENT = r"(?s)<!--.*?-->"
_BREAKS = rf"(?i)(</?(?:{'|'.join(CONTAINER_TAGS)}|p)(?:\s[^>]*)?>)"
_OPEN = rf"(?i)^<(?:{'|'.join(CONTAINER_TAGS)})[\s>]"
_CLOSE = rf"(?i)^</(?:{'|'.join(CONTAINER_TAGS)})[\s>]"
_PARAGRAPH = r"(?i)^<p[\s>]"


def drop_noise(page: Column) -> Column:
    def without(page):
        # Most pages close a few of these elements only; the others need no search. What is dropped leaves a blank,
        # so it can't bring a closing tag about.
        closed = let(F.lower(page), lambda low: F.filter(
            F.array(*[F.lit(tag) for tag in NOISE_TAGS]), lambda tag: F.contains(low, F.concat(F.lit("</"), tag))))
        return F.aggregate(closed, page, lambda left, tag: F.regexp_replace(
            left, F.concat(F.lit("(?is)<"), tag, F.lit(r"(?:\s[^>]*)?>.*?</"), tag, F.lit(r"\s*>")), F.lit(" ")))

    return let(F.regexp_replace(page, _COMMENT, " "), without)


def _classify(pieces: Column) -> Column:
    """Pieces with what they start with: 1 opens a container, -1 closes one, 2 is a paragraph."""
    return F.transform(
        pieces,
        lambda piece: F.struct(
            F.when(F.rlike(piece, F.lit(_PARAGRAPH)), 2)
            .when(F.rlike(piece, F.lit(_OPEN)), 1)
            .when(F.rlike(piece, F.lit(_CLOSE)), -1)
            .otherwise(0).alias("kind"),
            piece.alias("text"),
        ),
    )


def _scan(pieces: Column) -> Column:
    """Paragraphs with the number of the outermost container they lie in (0 outside of any)."""
    start = F.struct(
        F.lit(0).alias("depth"),
        F.lit(0).alias("container"),
        F.array().cast("array<struct<container:int,text:string>>").alias("paragraphs"),
    )

    def step(state, piece):
        kind, depth = piece["kind"], state["depth"]
        entry = F.struct(
            F.when(depth > 0, state["container"]).otherwise(0).alias("container"),
            piece["text"].alias("text"),
        )
        return F.struct(
            F.when(kind == 1, depth + 1)
            .when(kind == -1, F.greatest(depth - 1, F.lit(0)))
            .otherwise(depth).alias("depth"),
            F.when((kind == 1) & (depth == 0), state["container"] + 1)
            .otherwise(state["container"]).alias("container"),
            F.when(kind == 2, F.array_append(state["paragraphs"], entry))
            .otherwise(state["paragraphs"]).alias("paragraphs"),
        )

    return F.aggregate(pieces, start, step, lambda s: s["paragraphs"])


def _best_container(found: Column) -> Column:
    """Container number with the most paragraphs, the earliest on a tie; 0 when there is none.

    Paragraphs arrive in document order, so each container is one run of equal numbers.
    """
    start = F.struct(
        F.lit(0).alias("best"), F.lit(0).alias("best_n"),
        F.lit(0).alias("current"), F.lit(0).alias("n"),
    )

    def step(state, paragraph):
        number = paragraph["container"]
        n = F.when(number == state["current"], state["n"] + 1).otherwise(1)
        wins = (number > 0) & (n > state["best_n"])
        return F.struct(
            F.when(wins, number).otherwise(state["best"]).alias("best"),
            F.when(wins, n).otherwise(state["best_n"]).alias("best_n"),
            F.when(number == 0, state["current"]).otherwise(number).alias("current"),
            F.when(number == 0, state["n"]).otherwise(n).alias("n"),
        )

    return F.aggregate(found, start, step, lambda s: s["best"])


def paragraphs(page: Column) -> Column:
    """Paragraph texts of the chosen container, in order, before entity decoding."""
    plain = drop_noise(F.replace(page, F.lit(_MARK), F.lit(" ")))
    pieces = F.split(F.regexp_replace(plain, _BREAKS, _MARK + "$1"), _MARK)

    def chosen(found):
        return let(
            _best_container(found),
            lambda best: F.filter(found, lambda p: (best == 0) | (p["container"] == best)),
        )

    kept = let(_scan(_classify(pieces)), chosen)
    return F.transform(kept, lambda p: F.regexp_replace(p["text"], TAG, " "))


def with_page_text(pages: DataFrame, page: str, out: str) -> DataFrame:
    """`pages` with the body text of column `page`; the empty string when nothing is readable."""
    marked = with_computed(pages, **{out: F.array_join(paragraphs(F.col(page)), _MARK)})
    plain = with_computed(marked.withColumn(out, decode_collapsed(F.col(out))), **{out: F.split(out, _MARK)})
    long = F.filter(F.transform(out, lambda p: F.trim(p)), lambda p: F.length(p) > MIN_PARAGRAPH_CHARS)
    return plain.withColumn(out, F.coalesce(F.array_join(long, "\n\n"), F.lit("")))
