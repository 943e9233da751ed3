"""Date text to timestamps. All functions give site wall time unless an offset is asked for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bantin.functions.columns import as_column, case_of

# Date pattern by journal, one table per route an article can take.
ROUTES = {
    "stream": {
        "default": "dd/MM/yyyy HH:mm",
        "saigontimes": "yyyy-MM-dd'T'HH:mm:ss",
    },
    "store": {
        "default": "dd/MM/yyyy",
        "saigontimes": "yyyy-MM-dd",
    },
    "batch": {
        "default": "dd/MM/yyyy HH:mm",
        "dantri": "yyyy-MM-dd HH:mm",
        "vtc": "dd/MM/yyyy HH:mm:ss ZZZZZ",
        "diendandoanhnghiep": "dd/MM/yyyy HH:mm:ss",
    },
}

# How each pattern is read: the part of the text it covers, and the parser pattern for it.
# Text after that part is ignored, as the lenient parser of older Spark versions did.
_DMY = "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
_YMD = "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_HM = "[0-9]{1,2}:[0-9]{1,2}"
_READERS = {
    "dd/MM/yyyy HH:mm": (f"^{_DMY} {_HM}", "d/M/yyyy H:m"),
    "dd/MM/yyyy HH:mm:ss": (f"^{_DMY} {_HM}:[0-9]{{1,2}}", "d/M/yyyy H:m:s"),
    "dd/MM/yyyy HH:mm:ss ZZZZZ": (f"^{_DMY} {_HM}:[0-9]{{1,2}} [+-][0-9]{{2}}:[0-9]{{2}}", "d/M/yyyy H:m:s xxx"),
    "yyyy-MM-dd'T'HH:mm:ss": (f"^{_YMD}T{_HM}:[0-9]{{1,2}}", "yyyy-M-d'T'H:m:s"),
    "yyyy-MM-dd HH:mm": (f"^{_YMD} {_HM}", "yyyy-M-d H:m"),
    "dd/MM/yyyy": (f"^{_DMY}", "d/M/yyyy"),
    "yyyy-MM-dd": (f"^{_YMD}", "yyyy-M-d"),
}

_OFFSET_AFTER_CLOCK = (
    r"([0-9]{1,2}:[0-9]{2}(:[0-9]{2})?(\.[0-9]+)?) ?(Z|\(?(GMT)?[+-][0-9]{2}:?[0-9]{2}\)?)$"
)
# The last second a nanosecond clock can hold (year 2262).
_MAX_EPOCH_SECONDS = 9223372036


def normalise_spaces(text) -> Column:
    """Any run of Unicode space (no-break space too) becomes one space; ends are trimmed."""
    return F.trim(F.regexp_replace(as_column(text), r"(?U)\s+", " "))


def _read(text: Column, pattern: str) -> Column:
    covered, parser = _READERS[pattern]
    if "ZZZZZ" in pattern:
        text = F.regexp_replace(text, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    return F.try_to_timestamp(F.regexp_extract(text, covered, 0), F.lit(parser))


def parse_date(journal, text, route: str = "stream") -> Column:
    """Read `text` by the journal's pattern on the given route; NULL when it does not fit."""
    table = ROUTES[route]
    clean = normalise_spaces(text)
    special: dict[str, list[str]] = {}
    for name, pattern in table.items():
        if name != "default":
            special.setdefault(pattern, []).append(name)
    branches = [(names, _read(clean, pattern)) for pattern, names in special.items()]
    return case_of(journal, branches, otherwise=_read(clean, table["default"]))


def parse_date_any(text, honour_offset: bool = False) -> Column:
    """Read any of the known styles: day-first dates, epoch seconds, ISO; NULL otherwise.

    Offsets are dropped (site wall time) unless `honour_offset` is set. The shape of the text chooses the
    one parser it goes to: only day-first dates have a slash, only ISO dates start with a year.
    """
    clean = normalise_spaces(text)
    bare = F.regexp_replace(clean, _OFFSET_AFTER_CLOCK, "$1")
    day_first = F.try_to_timestamp(bare, F.lit("d/M/yyyy[ H:mm[:ss]]"))
    is_number = clean.rlike(r"^[0-9]{1,10}(\.[0-9]{1,6})?$")
    seconds = F.when(is_number, clean).try_cast("decimal(17,6)")
    epoch = F.when(
        seconds <= F.lit(_MAX_EPOCH_SECONDS),
        F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone()),
    )
    iso = bare.try_cast("timestamp_ntz").cast("timestamp")
    has_slash, has_year_first = F.contains(clean, F.lit("/")), bare.rlike("^[0-9]{4}-")
    if not honour_offset:
        return F.when(has_slash, day_first).when(is_number, epoch).when(has_year_first, iso)
    zoned_text = F.regexp_replace(
        F.regexp_replace(clean, r" ?\(?(?:GMT)?([+-][0-9]{2}):?([0-9]{2})\)?$", "$1:$2"), "Z$", "+00:00"
    )
    has_offset = zoned_text.rlike("[+-][0-9]{2}:[0-9]{2}$")
    zoned_day_first = F.when(has_offset, F.try_to_timestamp(zoned_text, F.lit("d/M/yyyy H:mm[:ss]xxx")))
    zoned_iso = F.when(has_offset, F.try_to_timestamp(zoned_text, F.lit("yyyy-MM-dd'T'HH:mm[:ss]xxx")))
    # What has an offset in a style of its own is read without it.
    return (
        F.when(has_slash, F.coalesce(zoned_day_first, day_first))
        .when(is_number, epoch)
        .when(has_year_first, F.coalesce(zoned_iso, iso))
    )


def parse_day(journal, text, route: str = "store") -> Column:
    """The day an article appeared, as midnight of that day."""
    return F.date_trunc("day", parse_date(journal, text, route))


def clean_date_text(journal, text) -> Column:
    """Undo each site's decoration of the date text; NULL where the rule finds no date."""
    raw = as_column(text)
    after_comma = F.split_part(raw, F.lit(","), F.lit(-1))
    words = F.split(raw, " ")
    return case_of(journal, [
        (["baodautu"], F.replace(raw, F.lit("- "), F.lit(""))),
        (["vietnamnet"], F.replace(after_comma, F.lit("- "), F.lit(""))),
        (["vneconomy"], F.when(F.size(words) >= 2, F.concat_ws(" ", F.get(words, F.lit(1)), F.get(words, F.lit(0))))),
        (["saigontimes"], F.trim(raw)),
        (["diendandoanhnghiep"], F.replace(raw, F.lit(","), F.lit(""))),
        (["nhipcaudautu"], F.trim(F.get(F.split(raw, r"\|"), F.lit(1)))),
        (["phapluatdoisong"], F.replace(after_comma, F.lit("| "), F.lit(""))),
        (["vtc", "laodong"], after_comma),
    ], otherwise=raw)


def year_month(date) -> Column:
    return F.date_format(as_column(date), "yyyy-MM")


def to_epoch_millis(date) -> Column:
    """Milliseconds since 1970 of the wall-clock reading, whatever the session time zone."""
    return F.unix_millis(F.from_utc_timestamp(as_column(date), F.current_timezone()))
