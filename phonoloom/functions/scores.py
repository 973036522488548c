"""Scores and decisions from measures: music, synthetic speech, recognition, terminal states. Plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from phonoloom.functions.classify import first_failure
from phonoloom.functions.signal import clamp, mean, variance

# Titles of tracks that are the uploader's own sound.
OWN_SOUND = ("", "original sound", "am thanh goc", "tieng dong goc")


def own_sound(title: Column) -> Column:
    """Whether a track's title says that it is no named work; a null title does."""
    return F.lower(F.trim(F.coalesce(title, F.lit("")))).isin(*OWN_SOUND)


def named_track(platform: Column, is_original: Column, track: Column) -> Column:
    """True where the platform's data name a commercial track, else null: the sound has to say."""
    return F.when((platform == "tiktok") & (is_original == F.lit(False)) & ~own_sound(track), F.lit(True))


def music_windows(duration: Column, window: float = 20.0) -> Column:
    """Starts of the windows to listen to: at the beginning, in the middle and at the end, each tenth of a second once.
    Null, NaN and negative durations give none."""
    begin, middle, end = F.lit(0.0), F.greatest(F.lit(0.0), duration / 2 - window / 2), F.greatest(F.lit(0.0), duration - window)
    key = lambda a: F.rint(a * 10)
    starts = F.array_compact(F.array(begin, F.when(key(middle) != 0, middle), F.when((key(end) != 0) & (key(end) != key(middle)), end)))
    return F.when(F.coalesce((duration >= 0) & ~F.isnan(duration), F.lit(False)), starts).otherwise(F.array().cast("array<double>"))


def music_window(harmonic: Column, contrast: Column, flatness: Column, seconds: Column, limits: tuple[float, float, float] = (0.45, 20.0, 0.015)) -> Column:
    """How much a window sounds like music, 0 for less than two seconds: half by its steady energy, the rest by the
    contrast of its bands and its lack of noise."""
    h, c, f = limits
    score = 0.5 * clamp((harmonic - 0.25) / (h - 0.25)) + 0.3 * clamp((contrast - 10.0) / (c - 10.0)) + 0.2 * clamp((f - flatness) / f)
    return F.when(seconds < 2, F.lit(0.0)).otherwise(score)


def prefilter(harmonic: Column, contrast: Column, flatness: Column, zcr: Column, seconds: Column) -> Column:
    """struct(music_prob, speech_prob, is_pure_music) of the fast listening; less than 1.5 seconds are taken as speech."""
    music = clamp(0.45 * clamp((harmonic - 0.20) / 0.35) + 0.35 * clamp((contrast - 12.0) / 12.0) + 0.20 * clamp((0.02 - flatness) / 0.02))
    speech = clamp(0.6 * (1 - F.least(F.lit(1.0), F.abs(zcr - 0.08) / 0.08)) + 0.4 * (1 - music))
    music, speech = F.when(seconds < 1.5, F.lit(0.0)).otherwise(music), F.when(seconds < 1.5, F.lit(1.0)).otherwise(speech)
    return F.struct(F.round(music, 4).alias("music_prob"), F.round(speech, 4).alias("speech_prob"), ((music > 0.70) & (speech < 0.25)).alias("is_pure_music"))


def synthetic(jitter: Column, flux: Column, mfcc_variance: Column, phase: Column, seconds: Column) -> Column:
    """How much sound looks made by a machine: weights .40 for an even pitch, .25 for an even spectrum, .20 for even
    cepstra, .15 for phases that are too regular or too wild. A pitch that can't be told leaves its weight out."""
    parts = [(0.40, F.nanvl(jitter, F.lit(None)), 0.008), (0.25, flux, 0.002), (0.20, mfcc_variance, 15.0)]
    known = [(F.when(v.isNotNull(), F.lit(w)).otherwise(F.lit(0.0)), F.coalesce(clamp(1 - v / limit), F.lit(0.0))) for w, v, limit in parts]
    known.append((F.lit(0.15), F.when((phase > 8.0) | (phase < 0.5), F.lit(0.75)).otherwise(F.lit(0.0))))
    return F.when(seconds < 2, F.lit(0.0)).otherwise(clamp(sum((w * s for w, s in known), F.lit(0.0)) / sum((w for w, _ in known), F.lit(0.0))))


def synthetic_by_levels(rms: Column, zcr: Column) -> Column:
    """The same from arrays of levels and crossings alone: both hardly vary in made speech."""
    return 0.6 * clamp(1 - variance(rms) / 0.001) + 0.4 * clamp(1 - variance(zcr) / 0.01)


def jitter(values: Column) -> Column:
    """Deviation of the first differences over the mean of an array; null for fewer than two values or a mean of 0."""
    n = F.size(values)
    steps = F.zip_with(F.slice(values, 2, F.greatest(n - 1, F.lit(0))), F.slice(values, 1, F.greatest(n - 1, F.lit(0))), lambda a, b: a - b)
    return F.when(n > 1, F.try_divide(F.sqrt(variance(steps)), mean(values)))


def flux(values: Column) -> Column:
    """Mean square of the first differences of an array; null for fewer than two values."""
    n = F.size(values)
    steps = F.zip_with(F.slice(values, 2, F.greatest(n - 1, F.lit(0))), F.slice(values, 1, F.greatest(n - 1, F.lit(0))), lambda a, b: (a - b) * (a - b))
    return F.when(n > 1, mean(steps))


def segment_means(segments: Column) -> Column:
    """struct(avg_logprob, no_speech_prob) over recognised segments; -1 and 1 if there are none."""
    n = F.size(segments)
    over = lambda name: F.try_divide(F.aggregate(segments, F.lit(0.0), lambda s, x: s + x[name]), n)
    return F.struct(F.when(n > 0, over("avg_logprob")).otherwise(F.lit(-1.0)).alias("avg_logprob"), F.when(n > 0, over("no_speech_prob")).otherwise(F.lit(1.0)).alias("no_speech_prob"))


def _filled(text: Column) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) > 0


def speech_post_gate(text: Column, logprob: Column, no_speech: Column, least: float = -0.5) -> Column:
    """Why a recognised text fails, null if it passes: no text, no speech, unsure. Unknown measures fail nothing."""
    return first_failure([(~_filled(text), "empty_transcript"), (no_speech > 0.50, "no_speech"), (logprob < least, "low_quality")])


def transcript_grade(success: Column, text: Column, logprob: Column, no_speech: Column) -> Column:
    """good, degraded or none."""
    heard = F.coalesce(success, F.lit(False)) & _filled(text)
    good, degraded = (logprob >= -0.5) & (no_speech <= 0.3), (logprob >= -0.8) & (no_speech <= 0.6)
    return F.when(heard & good, F.lit("good")).when(heard & degraded, F.lit("degraded")).otherwise(F.lit("none"))


def is_good_quality(success: Column, text: Column, logprob: Column, no_speech: Column) -> Column:
    """Whether a text can be taken as it is: at least five characters, sure enough."""
    return F.coalesce(F.coalesce(success, F.lit(False)) & (F.length(F.trim(F.coalesce(text, F.lit("")))) >= 5) & (logprob >= -0.7) & (no_speech <= 0.4), F.lit(False))


def recognition_gate(words: Column, no_speech: Column) -> Column:
    """Whether a segment holds no speech: fewer than three words, or silence more likely than not; unknown is 0."""
    return (F.coalesce(words, F.lit(0)) < 3) | (F.coalesce(F.nanvl(no_speech, F.lit(None)), F.lit(0.0)) > 0.50)


def residual_music(music_after: Column, separated: Column) -> Column:
    """Whether too much music is left after the voice was separated."""
    return F.coalesce(separated & (music_after > 0.20), F.lit(False))


def terminal_status(done_before: Column, record_found: Column, seen: Column, rejected: Column, segments: Column, error: Column) -> Column:
    """How the work on an address ended: error, skipped, rejected, done. Known addresses and seen ids are skipped, an
    address without a record or without an accepted segment is rejected."""
    told = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(told(done_before), F.lit("skipped"))
        .when(error.isNotNull(), F.lit("error"))
        .when(~told(record_found), F.lit("rejected"))
        .when(told(seen), F.lit("skipped"))
        .when(told(rejected) | (F.coalesce(segments, F.lit(0)) == 0), F.lit("rejected"))
        .otherwise(F.lit("done"))
    )


def separation_engine(mode: Column, has_cascade: Column, has_spectral: Column) -> Column:
    """Which engine separates the voice: the fast one where the mode asks for it, the cascade where it is there, else
    the spectral one, or none."""
    return F.when(mode == "cloud", F.lit("fast_spectral")).when(F.coalesce(has_cascade, F.lit(False)), F.lit("cascade")).when(F.coalesce(has_spectral, F.lit(False)), F.lit("spectral")).otherwise(F.lit("none"))


def allowed(user: Column, users: list) -> Column:
    """Whether a user may ask; an empty list lets all."""
    return user.isin(*users) if users else F.lit(True)
