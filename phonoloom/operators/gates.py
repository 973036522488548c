"""Gates in their order, with the first reason to reject an item."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from phonoloom.functions.classify import first_failure
from phonoloom.functions.text import word_count


# The shortest and longest item, and segment, in seconds.
ITEM_SECONDS, SEGMENT_SECONDS = (5.0, 7200.0), (3.0, 7200.0)


def item_gates(seconds: tuple[float, float] = ITEM_SECONDS) -> Column:
    """The first gate that an extended record fails, null if it passes all. Unknown measures fail no gate. Segments have
    limits of their own."""
    snr, d = F.nanvl(F.col("snr_db"), F.lit(None)), F.nanvl(F.col("duration_seconds"), F.lit(None))
    return first_failure(
        [
            (d < seconds[0], "too_short"),
            (d > seconds[1], "too_long"),
            (F.col("music_prob") >= 0.70, "music_quarantine"),
            (F.col("synthetic_prob") > 0.70, "synthetic"),
            (((snr < 12.0) | (F.col("speech_ratio") < 0.25)) & (snr < 10.0), "low_quality"),
            (F.col("music_prob") >= 0.30, "residual_music"),
            (word_count(F.col("transcript_raw")) < 3, "no_speech"),
            (F.col("content_decision") == "REJECT", "content"),
        ]
    )


def low_voice(rms: Column, speech_seconds: Column, ratio: Column) -> Column:
    """Whether there is too little voice: too quiet, too short, or too small a share."""
    return (rms < 0.004) | (speech_seconds < 1.8) | (ratio < 0.15)
