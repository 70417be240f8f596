"""Scene observations as a stream: the batch expressions with a watermark.

The method itself has no streams; this keeps yearly or windowed composites up to date as
scenes arrive. State holds a partial aggregate a key and window and is dropped behind the
watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapair.config import SceneConfig
from terrapair.operators import scenes


def prepared(stream: DataFrame, cfg: SceneConfig = SceneConfig()) -> DataFrame:
    """Cloud-free observations of a stream; stateless, the same as for a table."""
    return scenes.prepare(stream, cfg)


def windowed_means(stream: DataFrame, keys: Sequence[str], ts: str, value: str, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Mean and count by key and tumbling window, final once the watermark has passed."""
    w = F.window(ts, window)
    out = stream.withWatermark(ts, late).groupBy(*keys, w.alias("w")).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
    return out.select(*keys, F.col("w.start").alias("start"), "mean", "n")
