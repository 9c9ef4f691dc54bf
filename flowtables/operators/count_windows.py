"""Windows over numbers of rows, in a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.operators.aggregates import Measures
from flowtables.plans.chunks import CHUNK, Split, ordered_chunks
from flowtables.plans.scan import row_number, scan_chunked


def count_window(df: DataFrame, order: Sequence[str], size: int, measures: Measures, slide: int | None = None,
                 split: Split = Split()) -> DataFrame:
    """After every `slide` rows, the measures of the last `size` rows (fewer at the start).

    `slide = size` by default. With `slide > size` the rows between two windows are in none. Rows after the last
    full slide never show up. Windows are numbered from 1 in `window_no`.

    Row numbers come from per-chunk counts, so the total order costs no single-task sort. Where the window is a
    multiple of the slide, rows are aggregated to slides first and only slides are repeated per window.
    """
    slide = slide or size
    if size < 1 or slide < 1:
        raise ValueError("size and slide must be at least 1")
    chunked = scan_chunked(ordered_chunks(df, [], order, split), {"__n": row_number()})
    windows = chunked.rows // slide
    return numbered_windows(chunked.df.drop(CHUNK), size, slide, measures, 1, chunked.rows // slide)


def numbered_windows(rows: DataFrame, size: int, slide: int, measures: Measures, first: int, last: int) -> DataFrame:
    """The windows from `first` to `last` of rows with their numbers `__n`, as far as these rows belong to them."""
    # Number of the slide a row arrives in; window k ends with slide k.
    rows = rows.where(F.col("__n") <= last * slide).withColumn("__slide", F.expr(f"cast((__n + {slide - 1}) div {slide} as bigint)"))
    if slide >= size:
        kept = rows.where((F.col("__slide") * slide - F.col("__n") < size) & (F.col("__slide") >= first))
        return kept.groupBy(F.col("__slide").alias("window_no")).agg(
            *[m.whole().alias(n) for n, m in measures.items()])
    if size % slide == 0:
        panes = rows.groupBy("__slide").agg(*[m.whole().alias(n) for n, m in measures.items()])
        low, high = F.greatest("__slide", F.lit(first)), F.least(F.col("__slide") + (size // slide - 1), F.lit(last))
        spread = panes.where(low <= high).withColumn("window_no", F.explode(F.sequence(low, high)))
        return spread.groupBy("window_no").agg(*[m.again(n).alias(n) for n, m in measures.items()])
    low = F.greatest("__slide", F.lit(first))
    high = F.least(F.expr(f"cast((__n + {size - 1}) div {slide} as bigint)"), F.lit(last))
    spread = rows.where(low <= high).withColumn("window_no", F.explode(F.sequence(low, high)))
    return spread.groupBy("window_no").agg(*[m.whole().alias(n) for n, m in measures.items()])
