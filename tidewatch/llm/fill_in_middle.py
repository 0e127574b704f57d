"""Fill-in-the-middle transformation by one repeated-capture match per text (operator 13).

A unit is a run of white space with the word behind it, or white space alone at the end of a text.
One fullmatch of ``(unit)*`` with the ``regex`` library keeps the end of every repetition of its group,
so ``match.ends(1)`` gives the number of units and both places to cut at without a loop over them. The
quantifiers are possessive: a unit can only be read in one way, and nothing is kept for stepping back,
so time and memory grow with the text alone.

Which documents change, their form and their cuts come from the SHA-256 of a seed and the id. Cuts are
code point offsets; texts are cut, put together and restored by SQL functions. A text that has one of
the markers stays as it is, so an output is always read back the same way.

Defined cases: a NULL text is empty; an empty text is plain with 0 units; a NULL id hashes as an empty
one; repeated rows give repeated rows; an empty table gives an empty result. Columns of the input stay
as they are beside the new column ``fim``, which replaces one of that name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StructField, StructType

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 42
#: Percent of documents that change, and percent of those in the form suffix, prefix, middle.
FIM_RATE, SPM_RATE = 50, 80
UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")


def unit_cuts(text: str | None, first: int, second: int) -> tuple[int, int, int]:
    """Number of units, and the offsets behind the smaller and the larger of both draws of units."""
    ends = [0, *UNITS.fullmatch(text or "").ends(1)]
    low, high = sorted((first % len(ends), second % len(ends)))
    return len(ends) - 1, ends[low], ends[high]


CUTS = ("n", "prefix_end", "middle_end")


@pandas_udf(StructType([StructField(name, LongType()) for name in CUTS]))
def cuts_udf(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for columns in parts:
        rows = [unit_cuts(*row) for row in zip(*columns, strict=True)]
        yield pd.DataFrame(rows, columns=CUTS)


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    fim_rate: int = FIM_RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """Add ``fim``: ``n, form, prefix_chars, middle_chars, output``."""
    first, second, third, fourth = draws(docs[doc_id], seed)
    whole = F.coalesce(docs[text], F.lit(""))
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(whole, F.lit(marker))
    plain = (whole == "") | marked | (third % 100 >= fim_rate)
    form = F.when(plain, PLAIN).when(fourth % 100 < spm_rate, SPM).otherwise(PSM)
    cut = F.struct(cuts_udf(docs[text], first, second).alias("cut"), form.alias("form"))
    kept = [docs[name] for name in docs.columns if name != "fim"]
    found = docs.select(*kept, cut.alias("fim"), whole.alias("fim whole text"))
    columns = [found[name] for name in found.columns[:-2]]
    whole, form, at = found["fim whole text"], F.col("fim.form"), F.col("fim.cut")
    prefix = F.substring(whole, F.lit(1), at["prefix_end"].cast("int"))
    middle = F.substring(
        whole, (at["prefix_end"] + 1).cast("int"), (at["middle_end"] - at["prefix_end"]).cast("int")
    )
    suffix = F.substring(whole, (at["middle_end"] + 1).cast("int"), F.char_length(whole))
    output = (
        F.when(form == PLAIN, whole)
        .when(form == SPM, F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    )
    changed = form != PLAIN
    fim = F.struct(
        at["n"].alias("n"),
        form.alias("form"),
        F.when(changed, at["prefix_end"]).alias("prefix_chars"),
        F.when(changed, at["middle_end"] - at["prefix_end"]).alias("middle_chars"),
        output.alias("output"),
    )
    return found.select(*columns, fim.alias("fim"))


def restored(output: Column, form: Column) -> Column:
    """The exact text from output and form alone."""
    parts = F.split(F.substring(output, F.lit(len(PREFIX) + 1), F.char_length(output)), "<[PSM]>", -1)
    prefix = F.when(form == SPM, parts[1]).otherwise(parts[0])
    suffix = F.when(form == SPM, parts[0]).otherwise(parts[1])
    return F.when(form == PLAIN, output).otherwise(F.concat(prefix, parts[2], suffix))
