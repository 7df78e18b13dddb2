"""Hash keys, row hashes and surrogate keys, all as built-in column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# fixed values of the key format
KEY_DELIMITER = "||"
KEY_NULL = "__NULL__"
MEMBER_NULL = "__N__"
ROW_DELIMITER = "|"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_part(c: Column | str) -> Column:
    """A business-key part as it is hashed: trimmed and lower-cased text, NULL as its token."""
    return F.coalesce(F.lower(F.trim(as_col(c).cast("string"))), F.lit(KEY_NULL))


def hash_key(cols: Sequence[Column | str], source: Column | str | None = None) -> Column:
    """SHA-256 of trimmed, lower-cased business-key parts and the record source."""
    parts = [as_col(c) for c in cols]
    if source is not None:
        parts.append(F.lit(source) if isinstance(source, str) else source)
    return F.sha2(F.concat_ws(KEY_DELIMITER, *[key_part(p) for p in parts]), 256)


def part_hash(part: Column | str, source: str) -> Column:
    """``hash_key`` of one business key whose ``key_part`` is given."""
    return F.sha2(F.concat_ws(KEY_DELIMITER, part, key_part(F.lit(source))), 256)


def narrow(c: Column | str) -> Column:
    """Text as bytes, for a shuffle: lower-case hex digits, as hash keys have, at two a byte, other text as it is. Equal texts give
    equal bytes, and ``widened`` gives the text back; NULL stays NULL."""
    text = as_col(c)
    raw = F.unhex(text)
    hexed = F.concat(F.lit(b"\x01"), raw)
    return F.when(F.lower(F.hex(raw)) == text, hexed).otherwise(F.concat(F.lit(b"\x00"), text.cast("binary")))


def widened(c: Column | str) -> Column:
    """The text that ``narrow`` was given."""
    raw = as_col(c)
    rest = F.substring(raw, 2, 2_147_483_647)
    return F.when(F.substring(raw, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def narrowed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with the text columns among ``cols`` narrowed."""
    return df.withColumns({c: narrow(f"`{c}`") for c in text_columns(df) if c in cols})


def narrow_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join on a key of both sides whose text columns are shuffled as bytes."""
    text = dict.fromkeys([*text_columns(left), *text_columns(right)])
    out = narrowed(left, text_columns(left)).join(narrowed(right, text_columns(right)), on, how)
    return out.withColumns({c: widened(f"`{c}`") for c in text})


def link_key(members: Sequence[Column | str]) -> Column:
    """SHA-256 of member hash keys in the order given; an absent member has its own token."""
    clean = [F.coalesce(as_col(m).cast("string"), F.lit(MEMBER_NULL)) for m in members]
    return F.sha2(F.concat_ws(KEY_DELIMITER, *clean), 256)


def row_hash(cols: Sequence[Column | str]) -> Column:
    """SHA-256 over tracked attributes; NULL counts as the empty text so positions never shift."""
    clean = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat_ws(ROW_DELIMITER, *clean), 256)


def surrogate_key(cols: Sequence[Column | str]) -> Column:
    """A positive 60-bit key from (business key, start): repeatable, no global numbering needed."""
    text = F.concat_ws(ROW_DELIMITER, *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")
