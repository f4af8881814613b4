"""Full case folding with the way back: which character of the original text each folded character came from.

Most letters fold to one letter that ``lower`` also gives, and ß is folded natively too. Texts with any other letter (İ,
ligatures, letters that fold upwards or were added to Unicode late) go through one Arrow function; all other texts
pass it as nulls. ``extra`` lists the folded positions that are a second or third part of one character's fold, so a folded position
belongs to the original one that is smaller by the number of extras up to it.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache
from itertools import groupby

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions.cols import ColumnLike, col

FOLDED = T.StructType([T.StructField("folded", T.StringType()), T.StructField("extra", T.ArrayType(T.IntegerType()))])
NATIVE = str.maketrans({"ς": "σ", "ſ": "s", "µ": "μ"})


def _native(letter: str) -> str:
    lowered = letter.lower().translate(NATIVE)
    return "ss" if lowered == "ß" else lowered


@cache
def special_letters() -> str:
    """Regular expression class of the letters that native folding gets wrong or that an older Unicode may not know."""
    def special(code: int) -> bool:
        letter = chr(code)
        folded, lowered = letter.casefold(), letter.lower()
        if folded == letter == lowered:
            return False
        late = unicodedata.ucd_3_2_0.category(letter) == "Cn"
        return late or len(lowered) > 1 or folded != _native(letter)

    codes = [c for c in range(sys.maxunicode + 1) if special(c)]
    runs = [[c for _, c in run] for _, run in groupby(enumerate(codes), lambda p: p[1] - p[0])]
    blocks: list[list[list[int]]] = []
    for run in runs:
        if blocks and run[0] - blocks[-1][-1][-1] < 0x1000:
            blocks[-1].append(run)
        else:
            blocks.append([run])
    # The bounds of a block are looked at first, so that most letters do not pass through hundreds of ranges.
    shown = lambda first, last: f"\\x{{{first:x}}}-\\x{{{last:x}}}"
    return "|".join(f"[{shown(b[0][0], b[-1][-1])}&&[{''.join(shown(r[0], r[-1]) for r in b)}]]" for b in blocks)


@cache
def expanding_letters() -> re.Pattern:
    """Letters whose fold is longer than one character."""
    return re.compile("[" + "".join(c for c in map(chr, range(sys.maxunicode + 1)) if len(c.casefold()) > 1) + "]")


def fold_with_extra(text: str) -> tuple[str, list[int]]:
    extra: list[int] = []
    for found in expanding_letters().finditer(text):
        at = found.start() + len(extra)
        extra.extend(range(at + 1, at + len(found[0].casefold())))
    return text.casefold(), extra


@F.pandas_udf(FOLDED)
def _fold_special(texts: pd.Series) -> pd.DataFrame:
    pairs = [(None, None) if t is None else fold_with_extra(t) for t in texts]
    return pd.DataFrame(pairs, columns=["folded", "extra"])


def _sharp_extra(lowered: Column) -> Column:
    """Folded positions of the second s of every ß of a lower-cased text."""
    pieces = F.split(lowered, "ß", -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))
    grown = F.aggregate(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1), start,
        lambda acc, piece: F.struct(
            (acc["at"] + F.length(piece) + 2).alias("at"),
            F.concat(acc["found"], F.array(acc["at"] + F.length(piece) + 1)).alias("found"),
        ),
        lambda acc: acc["found"],
    )
    return F.when(lowered.contains("ß"), grown).otherwise(F.array().cast("array<int>"))


def _fold_native(value: Column) -> Column:
    return F.replace(F.translate(F.lower(value), "ςſµ", "σsμ"), F.lit("ß"), F.lit("ss"))


def folding(value: ColumnLike) -> Column:
    """struct<folded, extra> of a text; null for null. Use on a materialised column: parts are read several times."""
    text = col(value)
    special = text.rlike(special_letters())
    native = F.struct(_fold_native(text).alias("folded"), _sharp_extra(F.lower(text)).alias("extra"))
    return F.when(special, _fold_special(F.when(special, text))).when(text.isNotNull(), native)


def fold(value: ColumnLike) -> Column:
    """The case-folded text."""
    text = col(value)
    special = text.rlike(special_letters())
    return F.when(special, _fold_special(F.when(special, text))["folded"]).otherwise(_fold_native(text))
