"""Record validation as column expressions: typed values plus the reasons a row fails.

Conversion is tolerant in the way typed record models are: an integer may arrive as
`1.0`, `"1"` or `true`, but not as `1.5`; text must be text; a required field must be
there. The verdict is one array column, so a scan is validated in one narrow pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ladderlake.functions.cleaning import float_id, to_float, to_text
from ladderlake.schemas import struct

ERRORS = "errors"
CORRUPT = "_corrupt_record"
NUMBERS = (IntegerType, LongType)

# Words accepted as booleans, text accepted as a whole number.
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")
WHOLE_NUMBER = r"^\s*([+-]?\d+)(?:\.0+)?\s*$"
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$"
INFINITE = r"(?i)^\s*[+-]?(inf(inity)?|nan)\s*$"


@dataclass(frozen=True)
class Field:
    """One field of a record: `kind` is int, float, text, bool, date, instant or nanos.

    `clean` replaces the conversion; a value it cannot convert must come out null.
    """

    name: str
    kind: str
    required: bool = True
    clean: Callable[[Column], Column] | None = None


# Fields of the weekly files.
PLAYER_RECORD = (
    Field("civ", "text"),
    Field("game_id", "int"),
    Field("match_rating_diff", "float"),
    Field("new_rating", "int"),
    Field("old_rating", "int"),
    Field("profile_id", "int", required=False, clean=float_id),
    Field("replay_summary_raw", "text", required=False, clean=to_text),
    Field("team", "int"),
    Field("winner", "bool"),
)
MATCH_RECORD = (
    Field("avg_elo", "float"),
    Field("duration", "nanos"),
    Field("game_id", "int"),
    Field("game_speed", "text"),
    Field("game_type", "text"),
    Field("irl_duration", "nanos"),
    Field("leaderboard", "text"),
    Field("map", "text"),
    Field("mirror", "bool"),
    Field("num_players", "int"),
    Field("patch", "int"),
    Field("raw_match_type", "float", required=False, clean=to_float),
    Field("replay_enhanced", "bool"),
    Field("started_timestamp", "instant"),
    Field("starting_age", "text"),
    Field("team_0_elo", "float"),
    Field("team_1_elo", "float"),
)
# Whole numbers of documents that may come with a fraction, which is cut off.
FRACTIONS = ("profile_id",)
# Fields a manifest must have.
MANIFEST_REQUIRED = (
    "db_dumps",
    "db_dumps.start_date",
    "db_dumps.num_matches",
    "db_dumps.matches_url",
    "db_dumps.players_url",
)
# Fields a leaderboard page must have.
PAGE_REQUIRED = (
    "statGroups",
    "statGroups.id",
    "statGroups.members",
    "statGroups.members.alias",
    "statGroups.members.country",
    "leaderboardStats",
    "leaderboardStats.statgroup_id",
    "leaderboardStats.rank",
    "leaderboardStats.lastmatchdate",
)


# ---- flat records ----------------------------------------------------------
def _int_of(raw: Column, type_name: str) -> Column:
    """Whole numbers of any type, and text that spells one."""
    if type_name == "string":
        # Only digits reach the cast: a cast that fails costs far more than the pattern.
        digits = F.regexp_extract(raw, WHOLE_NUMBER, 1)
        return F.nullif(digits, F.lit("")).try_cast("bigint")
    if type_name.startswith(("double", "float", "decimal")):
        return F.when(raw == F.floor(raw), raw.try_cast("bigint"))
    return raw.try_cast("bigint")


def _float_of(raw: Column, type_name: str) -> Column:
    """Numbers, and text that spells one; suffixes that a cast would take are no number."""
    if type_name != "string":
        return raw.try_cast("double")
    return F.when(raw.rlike(NUMBER) | raw.rlike(INFINITE), F.trim(raw).try_cast("double"))


def _bool_of(raw: Column, type_name: str) -> Column:
    if type_name == "boolean":
        return raw
    if type_name != "string":
        return F.when(raw == 1, True).when(raw == 0, False)
    word = F.lower(raw)
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def _instant_of(raw: Column, type_name: str) -> Column:
    if type_name == "date" or type_name.startswith("timestamp"):
        return raw.try_cast("timestamp")
    # A number counts seconds, or milliseconds where it would lie far in the future. Text
    # that spells a number is one.
    secs = _float_of(raw, type_name)
    counted = F.timestamp_seconds(F.when(F.abs(secs) > 2e10, secs / 1000).otherwise(secs))
    if type_name != "string":
        return counted
    return F.when(raw.rlike(NUMBER), counted).otherwise(raw.try_cast("timestamp"))


def _value(raw: Column, field: Field, type_name: str) -> Column:
    if field.clean:
        return field.clean(raw)
    match field.kind:
        case "int" | "nanos":
            return _int_of(raw, type_name)
        case "float":
            return _float_of(raw, type_name)
        case "text":
            return raw if type_name == "string" else F.lit(None).cast("string")
        case "bool":
            return _bool_of(raw, type_name)
        case "date":
            return raw.try_cast("date")
        case "instant":
            return _instant_of(raw, type_name)
    raise ValueError(f"unknown kind {field.kind}")


def _reasons(*tests: Column) -> Column:
    """Array of the reasons that apply; `tests` are null where they do not."""
    return F.array_remove(F.array(*[F.coalesce(t, F.lit("")) for t in tests]), "")


def judge(df: DataFrame, fields: Sequence[Field], *keep: str) -> DataFrame:
    """Typed fields of the model, the `keep` columns, and `errors`: one reason per bad field."""
    types = dict(df.dtypes)
    values, reasons = [], []
    for f in fields:
        raw = F.col(f.name) if f.name in types else F.lit(None).cast("string")
        value = _value(raw, f, types.get(f.name, "string"))
        given = raw.isNotNull()
        if f.clean is float_id and types.get(f.name) in ("double", "float"):
            # "Not a number" is how a float column says that there is no identifier.
            given = given & ~F.isnan(raw)
        wrong = F.when(given & value.isNull(), f"{f.name}: not a valid {f.kind}")
        reasons.append(wrong.when(raw.isNull(), f"{f.name}: missing") if f.required else wrong)
        values.append(value.alias(f.name))
    # A filter on the verdict would be pushed below this projection and every conversion
    # computed twice. Rows that come out of a generator are filtered after it, so all is
    # computed once.
    row = F.struct(*values, *keep, _reasons(*reasons).alias(ERRORS))
    return df.select(F.inline(F.array(row)))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size(ERRORS) == 0).drop(ERRORS)


def quarantined(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size(ERRORS) > 0)


# ---- nested documents ------------------------------------------------------
def _lacks(value: Column, kind: DataType, path: Sequence[str]) -> Column:
    """Whether any place the path leads to is empty. Absent parents are their own error."""
    if isinstance(kind, ArrayType):
        return F.exists(value, lambda item: _lacks(item, kind.elementType, path))
    if not path:
        return value.isNull()
    child = value[path[0]]
    if len(path) == 1:
        return value.isNull() | child.isNull()
    return child.isNotNull() & _lacks(child, kind[path[0]].dataType, path[1:])


def _as_text(kind: DataType) -> DataType:
    """The layout with numbers read as text, which takes them however they are written."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _as_text(f.dataType)) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(_as_text(kind.elementType))
    return StringType() if isinstance(kind, NUMBERS) else kind


def _number(text: Column, kind: DataType, name: str) -> Column:
    if name in FRACTIONS:
        return _float_of(text, "string").try_cast(kind)
    return _int_of(text, "string").try_cast(kind)


def _typed(value: Column, kind: DataType, name: str = "") -> Column:
    if isinstance(kind, StructType):
        fields = [_typed(value[f.name], f.dataType, f.name).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda item: _typed(item, kind.elementType, name))
    return _number(value, kind, name) if isinstance(kind, NUMBERS) else value


def _lost(given: Column, typed: Column, kind: DataType) -> Column:
    """Whether any number of the document is given but spells none, so that its value is null.

    Compares the two layouts place by place, so that nothing is converted again.
    """
    if isinstance(kind, StructType):
        tests = [_lost(given[f.name], typed[f.name], f.dataType) for f in kind if _counts(f.dataType)]
        return reduce(lambda a, b: a | b, tests, F.lit(False))
    if isinstance(kind, ArrayType):
        if not _counts(kind):
            return F.lit(False)
        pairs = F.zip_with(given, typed, lambda a, b: _lost(a, b, kind.elementType))
        return F.coalesce(F.exists(pairs, lambda lost: lost), F.lit(False))
    return given.isNotNull() & typed.isNull()


def _counts(kind: DataType) -> bool:
    """Whether the layout has a number anywhere."""
    if isinstance(kind, StructType):
        return any(_counts(f.dataType) for f in kind)
    return _counts(kind.elementType) if isinstance(kind, ArrayType) else isinstance(kind, NUMBERS)


def parse_documents(df: DataFrame, text: str, ddl: str, alias: str = "doc") -> DataFrame:
    """Parse JSON text against a declared schema; what does not fit leaves the original
    text in the document's `_corrupt_record`.

    Whole numbers are taken as flat records take them: 5, 5.0 and "5" are one number.
    """
    layout = struct(ddl)
    schema = StructType([*_as_text(layout).fields]).add(CORRUPT, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    given, typed = f"_{alias}_given", f"_{alias}_typed"
    parsed = df.withColumn(given, F.from_json(text, schema, options))
    # Read twice below, so Catalyst keeps it a step of its own and converts every number once.
    parsed = parsed.withColumn(typed, _typed(F.col(given), layout))
    lost = _lost(F.col(given), F.col(typed), layout)
    corrupt = F.coalesce(F.col(given)[CORRUPT], F.when(lost, F.col(text)))
    fields = [F.col(typed)[f.name].alias(f.name) for f in layout]
    doc = F.struct(*fields, corrupt.alias(CORRUPT))
    return parsed.withColumn(alias, doc).drop(given, typed)


def judge_documents(
    df: DataFrame, ddl: str, required: Sequence[str], doc: str = "doc"
) -> DataFrame:
    """Add `errors` to parsed documents: malformed or mistyped text, missing required fields."""
    schema = struct(ddl)
    reasons = [F.when(F.col(doc)[CORRUPT].isNotNull(), "document: malformed or mistyped")]
    for name in required:
        lacks = _lacks(F.col(doc), schema, name.split("."))
        reasons.append(F.when(lacks, f"{name}: missing"))
    return df.withColumn(ERRORS, _reasons(*reasons))


# ---- manifests -------------------------------------------------------------
def manifest_entries(manifest: DataFrame, *keep: str, dumps: str = "db_dumps") -> DataFrame:
    """One row per weekly dump; `warning` is set where a dump is listed but holds nothing."""
    notice = F.concat(F.lit("File "), F.col("start_date"), F.lit(" is present but is empty!"))
    return manifest.select(*keep, F.inline(dumps)).withColumn(
        "warning", F.when(F.col("num_matches") == 0, notice)
    )
