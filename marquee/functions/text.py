"""Text normalisation and multi-value text parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions._util import as_col

# The two regular expressions of the title normaliser exactly as
# the reference hands them to Java.  In ``as_written`` mode the character
# class keeps a literal backslash and 's', and the second pattern means
# "backslash followed by s's", so whitespace is never collapsed.
AS_WRITTEN_STRIP = r"[^a-z0-9\\s]"
AS_WRITTEN_COLLAPSE = r"\\s+"


def normalize_title(c: Column | str, mode: str = "intent") -> Column:
    """comparable title key.

    ``intent``: lower-case, non-alphanumerics -> space, collapse blanks, trim.
    ``as_written``: the reference's operation order (strip before lower-case)
    which deletes capitals and never collapses whitespace.
    """
    t = as_col(c)
    if mode == "intent":
        low = F.lower(t)
        x = F.regexp_replace(low, r"[^a-z0-9\s]", " ")
        # most titles are clean, and deleting what a key may hold shows it far more cheaply than an expression
        clean = (F.translate(low, "abcdefghijklmnopqrstuvwxyz0123456789 ", "") == "") & ~low.contains("  ")
        return F.trim(F.when(clean, low).otherwise(F.regexp_replace(x, r"\s+", " ")))
    if mode == "as_written":
        x = F.regexp_replace(F.regexp_replace(t, AS_WRITTEN_STRIP, " "), AS_WRITTEN_COLLAPSE, " ")
        return F.lower(F.trim(x))
    raise ValueError(f"unknown mode {mode!r}")


def split_csv_list(c: Column | str) -> Column:
    """comma list -> array of trimmed, non-empty tokens ([] for NULL)."""
    parts = F.split(F.coalesce(as_col(c), F.lit("")), ",")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


# a quoted piece (with escapes) or a run without quotes; no step is undone, so long texts need no deep stack
_PIECES = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^'"]++"""


def _literal_as_json(c: Column) -> Column:
    """Python literal -> JSON.  Keywords and trailing commas are rewritten
    outside quotes only, so a name may hold them; \\xNN escapes inside."""
    def piece(x: Column) -> Column:
        quoted = x.startswith("'") | x.startswith('"')
        plain = x
        for python, json in (("None", "null"), ("True", "true"), ("False", "false")):
            plain = F.regexp_replace(plain, rf"\b{python}\b", json)
        plain = F.regexp_replace(plain, r",(\s*[\]}])", "$1")
        # most pieces need no rewriting: a plain search is far cheaper than four expressions
        spare_comma = x.contains(",") & x.rlike(r",\s*[\]}]")
        rewritten = F.when(x.contains("None") | x.contains("True") | x.contains("False") | spare_comma, plain).otherwise(x)
        unescaped = F.when(x.contains("\\x"), F.regexp_replace(x, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")).otherwise(x)
        return F.when(quoted, unescaped).otherwise(rewritten)

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_PIECES), F.lit(0)), piece), "")


_JSON_OPTS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true",
              "mode": "PERMISSIVE"}


def _literal_struct_array(c: Column, key: str) -> Column:
    """The dicts of a list literal; items that are no dict are skipped, and
    anything that is no list gives NULL."""
    t = F.trim(c)
    json = _literal_as_json(t)
    items = F.from_json(json, "array<string>", _JSON_OPTS)
    dicts = F.transform(F.filter(items, lambda x: x.startswith("{")),
                        lambda x: F.from_json(x, f"struct<`{key}`:string>", _JSON_OPTS))
    return F.when(t.startswith("[") & t.endswith("]"), dicts)


# The plain form of a list of dicts, as Python writes it - quoted texts whose only escape is \\xNN.
_QUOTED = r"""'[^'\\\p{Cntrl}]*+(?:\\x[0-9a-fA-F]{2}[^'\\\p{Cntrl}]*+)*+'|"[^"\\\p{Cntrl}]*+(?:\\x[0-9a-fA-F]{2}[^"\\\p{Cntrl}]*+)*+\""""
_VALUE = rf"(?:{_QUOTED}|None|True|False|-?(?:0|[1-9]\d{{0,17}}+))"
_MARK = "\x01"


def _plain_names(t: Column, key: str) -> Column:
    """The ``key`` values of a list literal in its plain form: dicts of plain
    values with one quoted ``key`` each.  NULL for any other text.

    Each dict from the text's start on is replaced by a mark and its value; the
    text is in the plain form if that leaves no more than the closing bracket."""
    other = rf"'(?!{key}')\w++': {_VALUE}"
    item = rf"\G(?:^\[|, )\{{(?:{other}, )*+'{key}': ({_QUOTED})(?:, {other})*+\}}"
    values = F.regexp_replace(t, item, f"{_MARK}$1")

    def names(v: Column) -> Column:
        json = F.concat(F.lit("["), F.replace(F.substring(v, 2, 2**31 - 1), F.lit(_MARK), F.lit(",")))
        json = F.when(json.contains("\\x"), F.regexp_replace(json, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")).otherwise(json)
        return F.when(v.rlike(rf"^(?:{_MARK}(?:{_QUOTED}))++\]$"), F.from_json(json, "array<string>", _JSON_OPTS))

    # a lambda names the replaced text, so that it is made once
    return F.when(t.startswith("[{") & ~t.contains(_MARK), F.transform(F.array(values), names)[0])


def literal_values(c: Column | str, key: str = "name") -> Column:
    """The ``key`` value of each dict of a list literal; NULL for what is no list."""
    c = as_col(c)
    t = F.trim(c)
    return F.coalesce(_plain_names(t, key), F.transform(_literal_struct_array(c, key), lambda x: x[key]))


def literal_names_text(c: Column | str, key: str = "name", values: Column | None = None) -> Column:
    """"[{'iso': .., 'name': ..}, ..]" -> "name1,name2"; NULL stays NULL,
    a list without dicts -> '', text that is not a parsable list comes back
    unchanged.  ``values``: the column's ``literal_values``, if they are there."""
    raw = as_col(c)
    return F.coalesce(F.array_join(literal_values(raw, key) if values is None else values, ","), raw)


def literal_names_array(c: Column | str, key: str = "name") -> Column:
    """list literal -> array of stripped, non-empty names ([] otherwise)."""
    names = F.transform(literal_values(c, key), lambda x: F.trim(x))
    kept = F.filter(names, lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(kept, F.array().cast("array<string>"))


def literal_or_csv_tokens(c: Column | str, key: str = "name", values: Column | None = None) -> Column:
    """Tokens of a multi-value text that may be a list literal: names of a
    parsable list literal (commas inside names survive), otherwise the
    comma-split text - the intent form of "join names with ',' then split".
    ``values`` as in ``literal_names_text``."""
    raw = as_col(c)
    names = F.filter(F.transform(literal_values(raw, key) if values is None else values, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    # names are NULL where the list is: the literal is parsed once
    return F.coalesce(names, split_csv_list(raw))


def comma_spacing(c: Column | str, pattern: str = r",\s|\s,") -> Column:
    """comma with an adjacent blank (NULL counts as no match)."""
    return F.coalesce(as_col(c), F.lit("")).rlike(pattern)


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the '||'-joined parts; NULL parts are skipped."""
    return F.md5(F.concat_ws("||", *[as_col(c).cast("string") for c in cols]))
