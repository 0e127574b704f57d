"""A filter of fixed size over keys, to leave out rows before they are shuffled.

Keys are hashed to ``BITS`` bits, kept as words of 64 in blocks of ``BLOCK_WORDS``. The filter has at most
``BITS / 64 / BLOCK_WORDS`` rows and ``BITS / 8`` bytes, 8 MB, whatever the number of keys, so it can
always be broadcast. It lets through every wanted key and, by chance, others: about one in six with ten
million keys, most with hundreds of millions. What it lets through is joined exactly afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import quoted

BITS = 1 << 26
BLOCK_WORDS = 1024
_NAMES = ("_block", "_word", "_mask")


def _place(key: Column, bits: int) -> dict[str, Column]:
    """Block, word in the block, and bit in the word, as a mask, of a key."""
    position = F.pmod(F.xxhash64(key), F.lit(bits))
    word = F.shiftright(position, 6)
    block = F.shiftright(word, BLOCK_WORDS.bit_length() - 1)
    mask = F.expr("shiftleft(1L, CAST(_position & 63 AS INT))")
    return {
        "_position": position,
        "_block": block.cast("int"),
        "_word": word.bitwiseAND(F.lit(BLOCK_WORDS - 1)).cast("int"),
        "_mask": mask,
    }


def _placed(df: DataFrame, key: str, bits: int) -> DataFrame:
    place = _place(F.col(quoted(key)), bits)
    placed = df.withColumn("_position", place.pop("_position"))
    return placed.withColumns(place).drop("_position")


def key_filter(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """``_block, _words`` over the keys of a frame; NULL keys are in nobody's way and left out.

    Repeats are combined before the shuffle, which so has at most ``bits / 64`` rows per task.
    """
    placed = _placed(keys.filter(F.col(quoted(key)).isNotNull()), key, bits).select(*_NAMES)
    words = placed.groupBy("_block", "_word").agg(F.bit_or("_mask").alias("_mask"))
    blocks = words.groupBy("_block").agg(
        F.map_from_entries(F.collect_list(F.struct("_word", "_mask"))).alias("_found")
    )
    word_numbers = F.sequence(F.lit(0), F.lit(BLOCK_WORDS - 1))
    return blocks.select(
        "_block",
        F.transform(
            word_numbers, lambda i: F.coalesce(F.try_element_at("_found", i), F.lit(0).cast("long"))
        ).alias("_words"),
    )


def might_match(df: DataFrame, key: str, wanted: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows whose key may be among the wanted ones; none of those is lost."""
    placed = _placed(df, key, bits)
    bit = F.get("_words", F.col("_word")).bitwiseAND(F.col("_mask"))
    return placed.join(F.broadcast(wanted), "_block").filter(bit != 0).select(*df.columns)
