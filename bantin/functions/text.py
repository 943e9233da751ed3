"""Text cleaning, author, tag and paragraph rules, and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bantin.functions.columns import as_column, bind, case_of

# The printable characters code page 1252 puts where Latin-1 has control codes.
_CP1252_PRINTED = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_CP1252_CODES = (
    "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e"
    "\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
)

_LOOKS_BROKEN = f"[\xc2-\xf4][\x80-\xbf{_CP1252_PRINTED}]"

# Journals that throw away empty paragraphs.
DROPS_EMPTY_PARAGRAPHS = ["vneconomy", "diendandoanhnghiep", "nhipcaudautu", "saigontimes"]
# Journals that throw away empty tags.
DROPS_EMPTY_TAGS = ["baodautu", "vneconomy", "saigontimes", "diendandoanhnghiep", "nhipcaudautu"]

# A word is a run of letters of any script with their marks, and of digits.
WORD = r"[\p{L}\p{M}\p{N}]+"


def unicode_trim(text) -> Column:
    """Trim every kind of Unicode space, no-break space included."""
    return F.regexp_replace(as_column(text), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def repair_encoding(text) -> Column:
    """Undo UTF-8 bytes that were read as Latin-1 or code page 1252; other text is kept.

    Only text that fits the single-byte range and turns into valid UTF-8 is changed.
    """


    def repair(raw: Column) -> Column:
        as_bytes = F.translate(raw, _CP1252_PRINTED, _CP1252_CODES)
        decoded = bind(as_bytes, lambda b: F.when(
            b.rlike(r"^[\x00-\xff]*$"), F.try_validate_utf8(F.encode(b, "ISO-8859-1").cast("string"))
        ))
        # Broken text shows a lead character (Â to ô) before a printed continuation byte.
        return F.when(raw.rlike(_LOOKS_BROKEN), F.coalesce(decoded, raw)).otherwise(raw)

    return bind(as_column(text), repair)


def clean_text(text) -> Column:
    """Repair the encoding, then trim; NULL stays NULL."""
    return unicode_trim(repair_encoding(text))


def clean_author(journal, author, paragraphs=None) -> Column:
    """Each site's author rule; some sites sign in the last paragraph."""
    raw = as_column(author)
    last = F.try_element_at(as_column(paragraphs), F.lit(-1)) if paragraphs is not None else raw
    return case_of(journal, [
        (["vneconomy"], F.replace(raw, F.lit(" -"), F.lit(""))),
        (["diendandoanhnghiep"], F.trim(F.split_part(raw, F.lit("|"), F.lit(1)))),
        (["vietnamnet"], last),
    ], otherwise=raw)


def clean_tags(journal, tags) -> Column:
    """Each site's tag rule: strip `#` or `,`, and drop empty tags where the site does."""
    raw = as_column(tags)
    full = F.filter(raw, lambda t: t.isNotNull() & (t != ""))
    return case_of(journal, [
        (["baodautu"], F.transform(full, lambda t: F.trim(F.replace(t, F.lit("#"), F.lit(""))))),
        (["cafef", "cafebiz"], F.transform(raw, lambda t: F.trim(F.replace(t, F.lit(","), F.lit(""))))),
        ([j for j in DROPS_EMPTY_TAGS if j != "baodautu"], full),
    ], otherwise=raw)


def drop_empty_paragraphs(content) -> Column:
    return F.filter(as_column(content), lambda p: p.isNotNull() & (p != ""))


def body_paragraphs(journal, paragraphs) -> Column:
    """The paragraphs that count as body text for the journal."""
    raw = as_column(paragraphs)
    without_signature = F.slice(raw, F.lit(1), F.greatest(F.size(raw) - 2, F.lit(0)))
    return case_of(journal, [
        (["phapluatdoisong"], without_signature),
        (DROPS_EMPTY_PARAGRAPHS, drop_empty_paragraphs(raw)),
    ], otherwise=raw)


def body_text(content) -> Column:
    """All paragraphs as one text; NULL when there is no list."""
    return F.array_join(as_column(content), " ")


def tokens(text) -> Column:
    """Lower-case words of the whole text, in order."""
    return F.regexp_extract_all(F.lower(as_column(text)), F.lit(WORD), F.lit(0))


def lemmatise(words, lemmas: dict[str, str]) -> Column:
    """Replace each word by its lemma from a small constant table (see the join for big ones)."""
    if not lemmas:
        return as_column(words)
    table = F.create_map(*[F.lit(x) for pair in sorted(lemmas.items()) for x in pair])
    return F.transform(as_column(words), lambda w: F.coalesce(F.try_element_at(table, w), w))


def remove_words(words, stop_words: list[str]) -> Column:
    """Words not in the list, order and repeats kept."""
    stop = list(dict.fromkeys(stop_words))
    if not stop:
        return as_column(words)
    return F.filter(as_column(words), lambda w: ~w.isin(*stop))


def word_runs(words, lengths: tuple[int, ...] = (2, 3, 4), stop_words: list[str] | None = None) -> Column:
    """Every run of 2 to 4 words as a phrase; none starts or ends with a stop word."""
    stop = list(dict.fromkeys(stop_words or []))

    def of_length(ws: Column, n: int) -> Column:
        starts = F.when(F.size(ws) >= n, F.sequence(F.lit(1), F.size(ws) - (n - 1))).otherwise(
            F.array().cast("array<int>")
        )
        if stop:
            starts = F.filter(
                starts,
                lambda i: ~F.element_at(ws, i).isin(*stop) & ~F.element_at(ws, i + (n - 1)).isin(*stop),
            )
        return F.transform(starts, lambda i: F.array_join(F.slice(ws, i, F.lit(n)), " "))

    return bind(as_column(words), lambda ws: F.concat(*[of_length(ws, n) for n in lengths]))


def count_values(values) -> Column:
    """array<struct<value, n>>: how often each value occurs in the array, by one sort."""

    def runs(sorted_values: Column) -> Column:
        size = F.size(sorted_values)
        positions = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(
            positions,
            lambda i: (i == 1) | (F.element_at(sorted_values, i) != F.get(sorted_values, i - 2)),
        )
        return bind(starts, lambda s: F.transform(
            s,
            lambda i, k: F.struct(
                F.element_at(sorted_values, i).alias("value"),
                (F.coalesce(F.get(s, k + 1), size + 1) - i).alias("n"),
            ),
        ))

    return bind(F.sort_array(as_column(values)), runs)
