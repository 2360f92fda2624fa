"""Column expressions for file names, lines, sequences and id arrays
(PRJ1-PRJ5, PRJ7, PRJ10-PRJ22).  All native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sequence markers and the bare word-boundary token.
BOS = "<s>"
EOS = "</s>"
DECODER_ONLY = "<decoder-only>"
BARE_SPACE = "Ġ"
EOL_MARKER = "<EOL>"
# White space, as members of a character class, as Python's str.split and
# str.strip see it and as JavaScript's trim does.
PY_WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
JS_WS = r"\t-\r\x{20}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body`` over a value that is computed once for the row, however often it is named."""
    return F.transform(F.array(value), body)[0]


def has_extension(name: Column | str, ext: str) -> Column:
    """PRJ1: exact suffix test (``ext`` like '.py')."""
    return _c(name).endswith(ext)


def is_null_line(value: Column | str) -> Column:
    """PRJ2: a token-document line that is exactly ``null``."""
    return _c(value) == F.lit("null")


def entry_id(*cols: Column | str) -> Column:
    """PRJ3: id fields joined with ':'; a null part is an error."""
    parts = [_c(c).cast("string") for c in cols]
    any_null = F.lit(False)
    for p in parts:
        any_null = any_null | p.isNull()
    return F.when(any_null, F.raise_error(F.lit("entry id field is null"))).otherwise(
        F.concat_ws(":", *parts))


def repo_key(filename: Column | str) -> Column:
    """PRJ4: text before the last '-'; error when there is none."""
    f = _c(filename)
    return F.when(F.instr(f, "-") == 0,
                  F.raise_error(F.concat(F.lit("file name has no '-': "), f))).otherwise(
        F.regexp_extract(f, r"^(.*)-[^-]*$", 1))


def repo_name(key: Column | str) -> Column:
    """PRJ5: first '_' becomes '/'; error when there is none."""
    k = _c(key)
    return F.when(F.instr(k, "_") == 0,
                  F.raise_error(F.concat(F.lit("repository key has no '_': "), k))).otherwise(
        F.regexp_replace(k, r"^([^_]*)_", "$1/"))


def nonblank(line: Column | str, ws: str = PY_WS) -> Column:
    """A line with at least one non-whitespace character (never bare trim)."""
    return _c(line).rlike(f"[^{ws}]")


def split_lines(content: Column | str) -> Column:
    """Lines of a file on '\\n' (PRJ7)."""
    return F.split(_c(content), "\n", -1)


def reader_lines(content: Column | str) -> Column:
    """Lines as a line reader yields them: CRLF, CR or LF ends a line."""
    return F.split(_c(content), "\r\n|\n|\r", -1)


def strip_ws(s: Column | str, ws: str = PY_WS) -> Column:
    """Remove leading and trailing whitespace (regex, not ``trim``)."""
    return F.regexp_replace(_c(s), rf"^[{ws}]+|[{ws}]+\z", "")


def normalise_ws(s: Column | str) -> Column:
    """PRJ11: split on whitespace and re-join with one space."""
    return F.array_join(ws_tokens(s), " ")


def ws_tokens(s: Column | str) -> Column:
    """Whitespace tokens (Python ``str.split()``); native ``array_remove``
    drops the empty edge pieces (no interpreted lambda)."""
    return F.array_remove(F.split(_c(s), f"[{PY_WS}]+"), "")


def drop_first_token(s: Column | str) -> Column:
    """PRJ12: whitespace tokens without the leading marker, re-joined."""
    t = ws_tokens(s)
    return F.array_join(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), " ")


def to_sequence(content: Column | str) -> Column:
    """PRJ10: '<s> ' + every non-blank line + ' </s> ' ... + ' </s>'."""
    lines = F.filter(reader_lines(content), lambda x: nonblank(x, JS_WS))
    body = F.when(F.size(lines) > 0, F.concat(F.array_join(lines, " </s> "), F.lit(" </s> "))).otherwise(F.lit(""))
    return F.concat(F.lit("<s> "), body, F.lit(" </s>"))


def newline_to_marker(s: Column | str) -> Column:
    """PRJ13: '\\n' -> ' </s> ' and a closing ' </s>'."""
    return F.concat(F.replace(_c(s), F.lit("\n"), F.lit(" </s> ")), F.lit(" </s>"))


def eol_to_marker(s: Column | str) -> Column:
    """PRJ14: '<EOL>' -> '</s>'."""
    return F.replace(_c(s), F.lit(EOL_MARKER), F.lit(EOS))


def normalise_literals(code: Column | str) -> Column:
    """PRJ15: literal placeholders to plain text.

    '<string'/'<number'/'<char' openings become the *_LIT forms; bare
    '<NUM_LIT>' -> '0', '<STR_LIT>' and '<CHAR_LIT>' -> ''; '<KIND_LIT:x>'
    -> x (x may span lines, shortest match).
    """
    c = _c(code)
    c = F.replace(c, F.lit("<string"), F.lit("<STR_LIT"))
    c = F.replace(c, F.lit("<number"), F.lit("<NUM_LIT"))
    c = F.replace(c, F.lit("<char"), F.lit("<CHAR_LIT"))
    c = F.replace(c, F.lit("<NUM_LIT>"), F.lit("0"))
    c = F.replace(c, F.lit("<STR_LIT>"), F.lit(""))
    c = F.replace(c, F.lit("<CHAR_LIT>"), F.lit(""))
    return F.regexp_replace(c, r"(?s)<(STR|NUM|CHAR)_LIT:(.*?)>", "$2")


def cut_prediction(text: Column | str, brace: str = "none") -> Column:
    """PRJ16: cut at the first '{' (exclusive / inclusive / none), then at
    the first '</s>'."""
    t = _c(text)
    if brace not in ("none", "exclusive", "inclusive"):
        raise ValueError("brace must be none, exclusive or inclusive")
    if brace != "none":
        pos = F.instr(t, "{")
        keep = pos - 1 if brace == "exclusive" else pos
        t = F.when(pos > 0, F.substring(t, F.lit(1), keep)).otherwise(t)
    return F.substring_index(t, EOS, 1)


def cut_at_pad(ids: Column | str, pad: int = 0) -> Column:
    """PRJ17: prefix of an id array before the first ``pad``."""
    a = _c(ids)
    pos = F.array_position(a, F.lit(pad))
    return F.when(pos > 0, F.slice(a, F.lit(1), (pos - 1).cast("int"))).otherwise(a)


def drop_bare_space(tokens: Column | str) -> Column:
    """PRJ18: remove the bare word-boundary token."""
    return F.array_remove(_c(tokens), BARE_SPACE)


def prefix_markers(tokens: Column | str) -> Column:
    """PRJ19: prepend <s>, <decoder-only>, </s>."""
    return F.concat(F.array(F.lit(BOS), F.lit(DECODER_ONLY), F.lit(EOS)), _c(tokens))


def keep_last(tokens: Column | str, w: int) -> Column:
    """PRJ20: left truncation to the last ``w`` elements."""
    if w < 1:
        raise ValueError("window must be >= 1 (length L must exceed 3)")
    a = _c(tokens)
    return F.slice(a, F.greatest(F.size(a) - F.lit(w) + 1, F.lit(1)), w)


def pad_right(ids: Column | str, length: int, pad: int = 1) -> Column:
    """PRJ21: right padding to ``length``."""
    a = _c(ids)
    return F.concat(a, F.array_repeat(F.lit(pad).cast("long"), F.greatest(F.lit(length) - F.size(a), F.lit(0))))


def non_pad_length(ids: Column | str, pad: int = 1) -> Column:
    """PRJ22: number of real (non-pad) ids."""
    return F.size(F.filter(_c(ids), lambda x: x != F.lit(pad)))
