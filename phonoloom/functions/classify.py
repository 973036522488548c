"""Classifiers and gates with a fixed order of precedence, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from phonoloom.functions import lexicons
from phonoloom.functions.text import padded, phrase_score, phrases_present, substrings_present, word_count

TARGETS = [("TIN_TUC_THOI_SU", "news"), ("PHAP_LUAT", "law"), ("HOC_ONLINE_GIAO_DUC", "edu")]


def content_text(transcript: Column, title: Column) -> Column:
    """The text to score: the title stands before and behind the transcript, so its phrases count twice.

    Make it a column of its own before scoring: inside a fold over phrases it would be made anew for each.
    """
    return padded(F.concat_ws(" ", title, transcript, title))


def content_scores(prepared: Column) -> dict[str, Column]:
    """Phrase scores of each content lexicon; ``prepared`` is a column of :func:`content_text`."""
    return {name: phrase_score(prepared, phrases) for name, phrases in lexicons.CONTENT.items()}


def content_class(transcript: Column, scores: dict[str, Column], threshold: float = 3.5) -> Column:
    """(category, confidence, action) by the ladder: too short, gambling, advertising, junk, the best target, talk.

    The word count is the transcript's alone. Limits are inclusive; a custom threshold applies to advertising and
    junk; equal targets go by their order.
    """
    best = F.greatest(*[scores[k] for _, k in TARGETS])
    target = F.coalesce(*[F.when(scores[k] == best, F.lit(name)) for name, k in TARGETS])

    def out(category: Column, confidence: Column, action: str) -> Column:
        return F.struct(category.alias("category"), F.round(confidence, 4).alias("confidence"), F.lit(action).alias("action"))

    return (
        F.when(word_count(transcript) < 3, out(F.lit("TRANSCRIPT_QUA_NGAN"), F.lit(1.0), "REJECT"))
        .when(scores["gambling"] >= 3.5, out(F.lit("SPAM_CO_BAC_DOC_HAI"), F.lit(0.95), "REJECT"))
        .when(scores["ads"] >= threshold, out(F.lit("QUANG_CAO_TIEP_THI"), F.least(F.lit(1.0), scores["ads"] / (threshold * 1.5)), "REJECT"))
        .when(scores["junk"] >= threshold, out(F.lit("NHAC_TREND_VO_NGHIA"), F.least(F.lit(1.0), scores["junk"] / (threshold * 1.5)), "REJECT"))
        .when(best >= 2.0, out(target, F.least(F.lit(1.0), 0.7 + best * 0.1), "ACCEPT"))
        .otherwise(out(F.lit("HOI_THOAI_DOI_SONG"), F.lit(0.85), "ACCEPT"))
    )


def text_region_scores(prepared: Column, low: Column) -> dict[str, Column]:
    """6 points for each dialect phrase present between word boundaries, 1 for each place name; of a column of
    :func:`text.worded`, and of the text in lower case."""
    return {r: phrases_present(prepared, lexicons.DIALECT[r]) * 6.0 + substrings_present(low, lexicons.PLACES[r]) * 1.0 for r in lexicons.REGIONS}


def channel_region(channel: Column) -> Column:
    """The region of the first known channel whose handle is in the name, or whose bare handle begins it."""
    name = F.lower(F.trim(channel))
    known = F.lit(None).cast("string")
    for mark, region in reversed(lexicons.CHANNELS):
        known = F.when(F.contains(name, F.lit(mark)) | name.startswith(mark.lstrip("@")), F.lit(region)).otherwise(known)
    return known


def region_class(scores: dict[str, Column], forced: Column | None = None) -> Column:
    """northern, southern, central or mixed. Nothing found, or a second of at least 4 points and 45 % of the first,
    is mixed; equal firsts go by the order of regions. A forced region wins."""
    n, s, c = (scores[r] for r in lexicons.REGIONS)
    top = F.greatest(n, s, c)
    second = n + s + c - top - F.least(n, s, c)
    first = F.coalesce(*[F.when(scores[r] == top, F.lit(r)) for r in lexicons.REGIONS])
    found = F.when(top == 0, F.lit("mixed")).when((second >= 4.0) & (second / top >= 0.45), F.lit("mixed")).otherwise(first)
    if forced is None:
        return found
    return F.coalesce(F.when(F.lower(forced).isin(*lexicons.REGIONS, "mixed"), F.lower(forced)), found)


def dialect_hits(prepared: Column) -> dict[str, Column]:
    """Phrases of each dialect present in a column of :func:`text.worded`."""
    return {name: phrases_present(prepared, phrases) for name, phrases in lexicons.VOCABULARY.items()}


def dialect_class(hits: dict[str, Column], pitch_std: Column, pitch_mean: Column, several: Column) -> Column:
    """Mixed, Central, South or North, from vocabulary first and pitch where no word decides."""
    c, s, n = hits["central"], hits["south"], hits["north"]
    two = ((c > 0) & ((s > 0) | (n > 0))) | ((s > 0) & (n > 0))
    mixed = (several & two) | ((c >= 1) & (s >= 1)) | ((c >= 1) & (n >= 1)) | ((s >= 2) & (n >= 2))
    return (
        F.when(mixed, F.lit("Mixed"))
        .when(c >= 1, F.lit("Central"))
        .when(s >= 1, F.lit("South"))
        .when(n >= 1, F.lit("North"))
        .when(pitch_std >= 38.0, F.lit("South"))
        .when((pitch_std > 0) & (pitch_std <= 20.0) & (pitch_mean < 170.0), F.lit("Central"))
        .otherwise(F.lit("North"))
    )


def music_status(prob: Column) -> Column:
    """clean below 0.30, music below 0.70, quarantine from there; unknown probabilities are clean."""
    return F.when(prob >= 0.70, F.lit("quarantine")).when(prob >= 0.30, F.lit("music")).otherwise(F.lit("clean"))


def synthetic_status(prob: Column) -> Column:
    """real, flagged above 0.30, rejected above 0.70."""
    return F.when(prob > 0.70, F.lit("rejected")).when(prob > 0.30, F.lit("flagged")).otherwise(F.lit("real"))


def speech_pre_gate(text: Column, logprob: Column, no_speech: Column) -> Column:
    """none without text or with much silence, good with clear speech, degraded between."""
    empty = F.length(F.trim(F.coalesce(text, F.lit("")))) == 0
    return F.when(empty | (no_speech > 0.60), F.lit("none")).when((logprob >= -0.45) & (no_speech < 0.35), F.lit("good")).otherwise(F.lit("degraded"))


def first_failure(tests: list[tuple[Column, str]]) -> Column:
    """The reason of the first test that holds, null if none does; a test on null doesn't hold."""
    reason = F.lit(None).cast("string")
    for test, name in reversed(tests):
        reason = F.when(F.coalesce(test, F.lit(False)), F.lit(name)).otherwise(reason)
    return reason


# What an error text says when trying again is of no use.
UNRECOVERABLE = ["no audio stream", "video unavailable", "this video is private", "private video", "post has been removed", "http error 404", "audio too short", "audio too long"]


def retryable(error: Column) -> Column:
    """Whether a failed item may be tried again; an empty or null error may."""
    return ~F.coalesce(F.lower(error).rlike("|".join(UNRECOVERABLE)), F.lit(False))
