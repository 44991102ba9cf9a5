"""Column functions on text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from brindle.functions.arrays import let


def strip_quotes(s: Column) -> Column:
    """Remove one enclosing pair of double quotes."""
    return F.regexp_replace(s, '^"(.*?)"$', "$1")


def tokenize(s: Column, stopwords: Sequence[str] = ()) -> Column:
    """Lower-case ASCII words of a text, in order and with repeats, without the stopwords."""
    words = F.split(F.lower(s), r"\W+")
    if not stopwords:
        return F.filter(words, lambda w: w != "")
    return F.filter(words, lambda w: (w != "") & ~w.isin(*stopwords))


def token_counts(tokens: Column) -> Column:
    """Distinct tokens of a list as an array of structs `token, c`, by runs of the sorted list.

    Counting inside the row keeps the tokens of a text out of the shuffle.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(
            starts,
            lambda start: F.transform(
                start,
                lambda i, j: F.struct(
                    F.get(ordered, i).alias("token"),
                    (F.coalesce(F.get(start, j + 1), F.size(ordered)) - i).alias("c"),
                ),
            ),
        )

    return F.when(F.size(tokens) > 0, let(F.sort_array(tokens), runs))


def regex_groups(line: Column, pattern: str, groups: int) -> Column:
    """All capture groups of a pattern that spans a whole line, or null when it does not match.

    One evaluation of the pattern yields every group, where `regexp_extract` would run it once per
    group. The groups are told apart by the one character that no line holds.
    """
    joined = F.regexp_replace(line, "(?d)" + pattern, "\n".join(f"${i}" for i in range(1, groups + 1)))
    one_line = ~F.contains(line, F.lit("\n"))
    return let(
        F.split(joined, "\n", -1), lambda found: F.when((F.size(found) == groups) & one_line, found)
    )


def basename(path: Column) -> Column:
    """Last component of a path, without a trailing newline."""
    return F.element_at(F.split(F.rtrim(path, F.lit("\n")), "/"), -1)


def rebase_path(path: Column, repo: str, prefix: str) -> Column:
    """Replace everything before the folder `repo` by `prefix`; null when `repo` is not in the path."""
    repo = repo.removesuffix("/")
    head = prefix.replace("\\", "/")
    head = head if not head or head.endswith("/") else head + "/"
    after = F.get(F.split(F.replace(path, F.lit("\\"), F.lit("/")), _quote(repo)), F.lit(1))
    return F.concat(F.lit(head + repo + "/"), F.regexp_replace(after, "^/", ""))


def _quote(literal: str) -> str:
    return r"\Q" + literal + r"\E"


def half_even_key(value: Column, title: Column) -> Column:
    """`'%.3f title'` sort key; rounds halves to even."""
    rounded = F.bround(value, 3).cast("decimal(30,3)")
    return F.concat_ws(" ", rounded.cast("string"), title)


def percent_label(value: Column) -> Column:
    """Whole percent, blank below 7."""
    return F.when(value < 7, F.lit("")).otherwise(
        F.concat(F.bround(value).cast("long").cast("string"), F.lit("%"))
    )
