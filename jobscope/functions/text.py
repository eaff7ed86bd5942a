"""Text cleaning and code extraction.

Every function returns a ``Column`` built from native Spark expressions, so it
runs inside whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# Criticality letters: A -> High, M -> Moderate, B -> Low.
# Criticality words kept as they are: High, Moderate, Low, Urgent; others -> R.
# Platform: centre prefix DS -> DISTRIBUIDA, anything else -> MAINFRAME.
# Date with a comma inside a quoted field: (")(\w+\s\d{1,2}),(\s\d{4}")
# ---------------------------------------------------------------------------
CRITICALITY_LETTERS = {"A": "High", "M": "Moderate", "B": "Low"}
CRITICALITY_WORDS = ["High", "Moderate", "Low", "Urgent"]
PLATFORM_DISTRIBUTED = "DISTRIBUIDA"
PLATFORM_MAINFRAME = "MAINFRAME"
DATE_COMMA_PATTERN = r'(")(\w+\s\d{1,2}),(\s\d{4}")'


def strip_quotes(c) -> Column:
    """remove every double quote."""
    return F.regexp_replace(_c(c), '"', "")


def drop_comma_in_date(c) -> Column:
    """``"May 20, 2025"`` -> ``"May 20 2025"`` inside a quoted field."""
    return F.regexp_replace(_c(c), DATE_COMMA_PATTERN, "$1$2$3")


def drop_commas(c) -> Column:
    """F2 (SQL form): ``REPLACE(x, ',', '')``."""
    return F.regexp_replace(_c(c), ",", "")


def trim(c) -> Column:
    """strip spaces at both ends."""
    return F.trim(_c(c))


def blank_to_null(c) -> Column:
    """``NULLIF(c, '')``."""
    return F.nullif(_c(c), F.lit(""))


def app_code(job, letter: str, test_len: int = 3) -> Column:
    """application code cut from a job name.

    LITERAL: ``IF(SUBSTRING(job,1,3) = letter, SUBSTRING(job,1,2), SUBSTRING(job,1,3))``,
    trimmed. A 3-character prefix equals a one-letter literal only when the
    name itself is that letter (trailing blanks ignored, as a PAD SPACE
    collation compares). ``test_len=1`` gives the evident meaning (first letter).
    """
    j = _c(job)
    head = F.rtrim(F.substring(j, 1, test_len))
    return F.trim(F.when(head == F.lit(letter), F.substring(j, 1, 2)).otherwise(F.substring(j, 1, 3)))


def last3(c) -> Column:
    """``TRIM(SUBSTRING(c, -3))``; a value shorter than 3 gives ''."""
    v = _c(c)
    return F.when(F.length(v) >= 3, F.trim(F.substring(v, -3, 3))).otherwise(
        F.when(v.isNotNull(), F.lit("")))


def platform(dc) -> Column:
    """``DS`` centres are distributed, every other prefix is mainframe."""
    return F.when(F.substring(_c(dc), 1, 2) == "DS", F.lit(PLATFORM_DISTRIBUTED)).otherwise(
        F.lit(PLATFORM_MAINFRAME))


def platform_prefix(dc) -> Column:
    """F12 (SQL form): the first two characters of the centre."""
    return F.substring(_c(dc), 1, 2)


def criticality(group_name) -> Column:
    """first letter A/M/B of the node group -> High/Moderate/Low, else NULL."""
    first = F.substring(_c(group_name), 1, 1)
    out = None
    for letter, word in CRITICALITY_LETTERS.items():
        out = (F.when(first == letter, F.lit(word)) if out is None
               else out.when(first == letter, F.lit(word)))
    return out


def normalise_criticality(c) -> Column:
    """letters to words, unknown words to ``R``, NULL stays NULL."""
    v = _c(c)
    out = None
    for letter, word in CRITICALITY_LETTERS.items():
        out = F.when(v == letter, F.lit(word)) if out is None else out.when(v == letter, F.lit(word))
    return out.when(~v.isin(*CRITICALITY_WORDS), F.lit("R")).otherwise(v)


def recode(c, mapping: dict, default=None) -> Column:
    """map values through a fixed dictionary (small maps -> ``CASE``).

    Unmapped values stay unchanged unless ``default`` is given.
    """
    v = _c(c)
    out = None
    for k, val in mapping.items():
        out = F.when(v == F.lit(k), F.lit(val)) if out is None else out.when(v == F.lit(k), F.lit(val))
    if out is None:
        return v
    return out.otherwise(v if default is None else F.lit(default))


def json_field(c, path: str) -> Column:
    """one field of a JSON text column (``$.JOBNAME_ADDINFO`` ...)."""
    return F.get_json_object(_c(c), path)


def incident_in_notes(notes) -> Column:
    """text from the first ``INC`` to the end, NULL when absent.

    LITERAL: the gate is case-insensitive but the search is case-sensitive, so
    ``inc123`` passes the gate and then finds nothing: NULL.
    """
    n = _c(notes)
    pos = F.instr(n, "INC")
    return F.when(F.upper(n).contains("INC") & (pos > 0), n.substr(pos, F.length(n)))


def digits_or_zero(c) -> Column:
    """an all-digit text becomes a number, anything else (and NULL) 0."""
    v = _c(c)
    return F.when(v.rlike("^[0-9]+$"), v.try_cast("long")).otherwise(F.lit(0)).cast("long")


def failed_ids(message) -> Column:
    """the comma-separated ids inside the first ``[...]`` of an error text, as an array of longs.

    Use with ``explode`` to get one row per id.
    """
    inner = F.regexp_extract(_c(message), r"\[([^\]]*)", 1)
    parts = F.split(inner, ",")
    return F.filter(F.transform(parts, lambda p: F.trim(p).try_cast("long")), lambda x: x.isNotNull())


def cap_threshold(valor, limit: int = 999, capped: str = "+30%") -> Column:
    """a threshold whose number (after dropping ``%``) exceeds ``limit`` becomes ``capped``."""
    v = _c(valor)
    num = F.regexp_replace(v, "%", "").try_cast("long")
    return F.when(num > limit, F.lit(capped)).otherwise(v)


def replace_prefix(c, like: str, new=None, old: str | None = None) -> Column:
    """where ``c LIKE like``: set to ``new``, or replace ``old`` by ``new`` inside it."""
    v = _c(c)
    if old is not None:
        repl = F.replace(v, F.lit(old), F.lit(new))
    else:
        repl = F.lit(new)
    return F.when(v.like(like), repl).otherwise(v)


def concat_fields(*cols) -> Column:
    """F16: ``CONCAT`` (NULL when any part is NULL, as in SQL)."""
    return F.concat(*[_c(c) for c in cols])


def resource_key(server, rerun, run_id) -> Column:
    """F16: ``server-rerun-run`` resource key of an event."""
    return F.concat_ws("-", _c(server), _c(rerun).cast("string"), _c(run_id))
