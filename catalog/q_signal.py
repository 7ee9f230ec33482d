"""Framing and short-term features over the clips."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as T
from catalog.registry import copy_views, query, view
from clipwright.functions import spectra as S, vectors as V
from clipwright.operators import signals

G = T.TOY

view("frames", "SELECT clip_id, frame, samples[frame * 4 + 1 : frame * 4 + 10] AS x FROM clips, range(0, 14) t(frame)", "clips")
view("wins", """
    SELECT a.clip_id, a.frame AS win, list_concat(a.x, b.x) AS x
    FROM frames a JOIN frames b ON a.clip_id = b.clip_id AND b.frame = a.frame + 1""", "frames")
view("level", """
    SELECT clip_id, mean, max(abs(v - mean)) + 1e-10 AS peak
    FROM (SELECT clip_id, v, avg(v) OVER (PARTITION BY clip_id) AS mean FROM (SELECT clip_id, unnest(x) AS v FROM frames))
    GROUP BY clip_id, mean""", "frames")
view("wpos", """
    SELECT clip_id, win, p, (x[p + 1] - mean) / peak AS v FROM wins JOIN level USING (clip_id), range(0, 20) t(p)""", "wins", "level")
view("spec", """
    SELECT clip_id, win, k, sqrt(power(sum(v * cos(2 * pi() * k * p / 20)), 2) + power(sum(v * sin(2 * pi() * k * p / 20)), 2)) / 10 AS m
    FROM wpos, range(0, 10) t(k) GROUP BY clip_id, win, k""", "wpos")
view("f_zcr", """
    SELECT clip_id, win, sum(abs(sign(v) - sign(before))) / 2.0::DOUBLE / 19 AS value
    FROM (SELECT *, lag(v) OVER (PARTITION BY clip_id, win ORDER BY p) AS before FROM wpos) GROUP BY clip_id, win""", "wpos")
view("f_energy", "SELECT clip_id, win, avg(v * v) AS value FROM wpos GROUP BY clip_id, win", "wpos")
view("f_energy_entropy", """
    SELECT clip_id, win, -sum(s * log2(s + 1e-8)) AS value
    FROM (SELECT clip_id, win, p // 2 AS b, sum(v * v) / (max(e) + 1e-8) AS s
          FROM (SELECT *, sum(v * v) OVER (PARTITION BY clip_id, win) AS e FROM wpos) GROUP BY clip_id, win, b)
    GROUP BY clip_id, win""", "wpos")
view("moments", """
    SELECT clip_id, win, max(c) AS centroid, sqrt(sum(power((k + 1) / 10.0::DOUBLE - c, 2) * w) / (sum(w) + 1e-8)) AS spread
    FROM (SELECT *, sum((k + 1) / 10.0::DOUBLE * w) OVER g / (sum(w) OVER g + 1e-8) AS c
          FROM (SELECT *, m / max(m) OVER (PARTITION BY clip_id, win) AS w FROM spec)
          WINDOW g AS (PARTITION BY clip_id, win))
    GROUP BY clip_id, win""", "spec")
view("f_spectral_entropy", """
    SELECT clip_id, win, -sum(s * log2(s + 1e-8)) AS value
    FROM (SELECT clip_id, win, m * m / (sum(m * m) OVER (PARTITION BY clip_id, win) + 1e-8) AS s FROM spec)
    GROUP BY clip_id, win""", "spec")
view("f_flux", """
    SELECT clip_id, win, sum(power(s - coalesce(before, s), 2)) AS value
    FROM (SELECT clip_id, win, k, s, lag(s) OVER (PARTITION BY clip_id, k ORDER BY win) AS before
          FROM (SELECT clip_id, win, k, m / (sum(m) OVER (PARTITION BY clip_id, win) + 10 * 1e-8) AS s FROM spec))
    GROUP BY clip_id, win""", "spec")
view("f_rolloff", """
    SELECT clip_id, win, coalesce(min(CASE WHEN running + 1e-8 > 0.9::DOUBLE * whole THEN k END), 0) / 10.0::DOUBLE AS value
    FROM (SELECT *, sum(m * m) OVER (PARTITION BY clip_id, win ORDER BY k ROWS UNBOUNDED PRECEDING) AS running,
                 sum(m * m) OVER (PARTITION BY clip_id, win) AS whole FROM spec)
    GROUP BY clip_id, win""", "spec")
view("edges", """
    SELECT i, CASE WHEN i < 13 THEN 133.33::DOUBLE + i * (200::DOUBLE / 3)
                   ELSE (133.33::DOUBLE + 12 * (200::DOUBLE / 3)) * power(1.0711703::DOUBLE, i - 12) END AS hz
    FROM range(0, 20) t(i)""")
view("bank", """
    SELECT f, b, CASE WHEN b < floor(c / 40) + 1 THEN 2 / (u - l) / (c - l) * (b * 40 - l)
                      ELSE 2 / (u - l) / (u - c) * (u - b * 40) END AS w
    FROM (SELECT i AS f, hz AS l, lead(hz, 1) OVER (ORDER BY i) AS c, lead(hz, 2) OVER (ORDER BY i) AS u FROM edges),
         range(0, 10) t(b)
    WHERE u IS NOT NULL AND b BETWEEN floor(l / 40) + 1 AND floor(u / 40)""", "edges")
view("f_mfcc", """
    SELECT clip_id, win, c + 1 AS c, sum(sqrt(CASE WHEN c = 0 THEN 1 ELSE 2 END / 18.0::DOUBLE)
           * cos(pi() * c * (2 * f + 1) / 36) * e) AS value
    FROM (SELECT s.clip_id, s.win, f, log10(coalesce(sum(w * m), 0) + 1e-8) AS e
          FROM (SELECT *, f FROM spec, range(0, 18) t(f)) s LEFT JOIN bank USING (f) WHERE b IS NULL OR b = k
          GROUP BY s.clip_id, s.win, f), range(0, 13) t(c)
    GROUP BY clip_id, win, c""", "spec", "bank")
view("pitch", """
    SELECT k, ((s % 12) + 12) % 12 AS c, 1.0::DOUBLE / count(*) OVER (PARTITION BY s) AS w
    FROM (SELECT k, CAST(round(12 * log2((k + 1) * 20 / 27.5::DOUBLE)) AS INTEGER) AS s FROM range(0, 10) t(k))""")
view("f_chroma", """
    SELECT clip_id, win, t.c + 1 AS c, coalesce(sum(CASE WHEN p.c = t.c THEN m * m * w END), 0) / sum(m * m) AS value
    FROM spec JOIN pitch p USING (k), range(0, 12) t(c) GROUP BY clip_id, win, t.c""", "spec", "pitch")
view("f_all", """
    SELECT clip_id, win, 'zcr' AS name, value FROM f_zcr
    UNION ALL SELECT clip_id, win, 'energy', value FROM f_energy
    UNION ALL SELECT clip_id, win, 'energy_entropy', value FROM f_energy_entropy
    UNION ALL SELECT clip_id, win, 'spectral_centroid', centroid FROM moments
    UNION ALL SELECT clip_id, win, 'spectral_spread', spread FROM moments
    UNION ALL SELECT clip_id, win, 'spectral_entropy', value FROM f_spectral_entropy
    UNION ALL SELECT clip_id, win, 'spectral_flux', value FROM f_flux
    UNION ALL SELECT clip_id, win, 'spectral_rolloff', value FROM f_rolloff
    UNION ALL SELECT clip_id, win, 'mfcc_' || c, value FROM f_mfcc
    UNION ALL SELECT clip_id, win, 'chroma_' || c, value FROM f_chroma
    UNION ALL SELECT clip_id, win, 'chroma_std', stddev_pop(value) FROM f_chroma GROUP BY clip_id, win""",
     "f_zcr", "f_energy", "f_energy_entropy", "moments", "f_spectral_entropy", "f_flux", "f_rolloff", "f_mfcc", "f_chroma")
view("f_delta", """
    SELECT clip_id, win, 'delta ' || name AS name,
           coalesce(value - lag(value) OVER (PARTITION BY clip_id, name ORDER BY win), 0) AS value FROM f_all""", "f_all")

# the whole chain: peak normalised, trimmed, framed; everything behind the frames as above
view("kept", """
    SELECT clip_id, list(v ORDER BY i) AS x
    FROM (SELECT clip_id, min(f) AS lo, max(f) AS hi
          FROM (SELECT clip_id, f, e, max(e) OVER (PARTITION BY clip_id) AS loudest
                FROM (SELECT clip_id, f, avg(v * v) AS e FROM peaked, range(0, 13) t(f)
                      WHERE i - 1 BETWEEN f * 4 AND f * 4 + 15 GROUP BY clip_id, f))
          WHERE e > loudest * 0.01::DOUBLE GROUP BY clip_id) JOIN peaked USING (clip_id)
    WHERE i - 1 BETWEEN lo * 4 AND hi * 4 + 15 GROUP BY clip_id""", "peaked")
view("peaked", """
    SELECT clip_id, i, v / max(abs(v)) OVER (PARTITION BY clip_id) AS v
    FROM (SELECT clip_id, i, samples[i] AS v FROM clips, range(1, 65) t(i))""", "clips")
view("whole_frames", """
    SELECT clip_id, frame, x[frame * 4 + 1 : frame * 4 + 10] AS x FROM kept, range(0, 14) t(frame)
    WHERE frame * 4 + 10 <= len(x)""", "kept")
copy_views("whole_", ["frames", "level", "wins", "wpos", "spec", "f_zcr", "f_energy", "f_energy_entropy", "moments",
                      "f_spectral_entropy", "f_flux", "f_rolloff", "f_mfcc", "f_chroma", "f_all", "f_delta"])

WINDOWED = "SELECT clip_id, CAST(win AS INTEGER) AS win, round(value, 6) + 0.0 AS value FROM "


def _windows(spark, d):
    return signals.with_windows(T.dealt(T.clips(spark, d).select("clip_id", "samples")), G)


def _spectra(spark, d):
    return signals.with_spectra(_windows(spark, d), G)


def _matrix(spark, d):
    values = signals.short_term_matrix(F.col("windows"), F.col("spectra"), G)
    return _spectra(spark, d).withColumn("matrix", signals.with_deltas(values))


def _windowed(df, values):
    rows = signals.per_window(df.withColumn("_v", values), "_v")
    return rows.select("clip_id", "win", *T.r6("value"))


def _long(df, values, name):
    """Array of arrays per clip -> (clip_id, win, place, value)."""
    rows = signals.per_window(df.withColumn("_v", values), "_v", "_row")
    return rows.select("clip_id", "win", F.posexplode_outer("_row").alias(name, "value")).select(
        "clip_id", "win", name, *T.r6("value")
    )


@query("peak_normalize", """
    SELECT clip_id, CAST(i - 1 AS INTEGER) AS idx, round(samples[i] / list_max(list_transform(samples, lambda s: abs(s))), 6) + 0.0 AS value
    FROM clips, range(1, 65) t(i)""", "clips")
def peak_normalize(spark, d):
    rows = T.clips(spark, d).select("clip_id", F.posexplode_outer(signals.peak_normalized(F.col("samples"))).alias("idx", "value"))
    return rows.select("clip_id", "idx", *T.r6("value"))


view("faded", """
    SELECT clip_id, i, samples[i] * CASE WHEN i <= 24 OR i > 44 THEN 0.001::DOUBLE ELSE 1.0::DOUBLE END AS v
    FROM clips, range(1, 65) t(i)""", "clips")


@query("trim_silence", """
    SELECT clip_id, CAST(i - 1 - lo * 4 AS INTEGER) AS idx, round(v, 6) + 0.0 AS value
    FROM (SELECT clip_id, min(f) AS lo, max(f) AS hi
          FROM (SELECT clip_id, f, e, max(e) OVER (PARTITION BY clip_id) AS loudest
                FROM (SELECT clip_id, f, avg(v * v) AS e FROM faded, range(0, 13) t(f)
                      WHERE i - 1 BETWEEN f * 4 AND f * 4 + 15 GROUP BY clip_id, f))
          WHERE e > loudest * 0.01::DOUBLE GROUP BY clip_id) JOIN faded USING (clip_id)
    WHERE i - 1 BETWEEN lo * 4 AND hi * 4 + 15""", "faded")
def trim_silence(spark, d):
    quiet = F.transform("samples", lambda s, i: s * F.when((i < 24) | (i >= 44), 0.001).otherwise(1.0))
    kept = signals.trimmed(quiet, G.trim_frame, G.trim_hop)
    rows = T.clips(spark, d).select("clip_id", F.posexplode_outer(kept).alias("idx", "value"))
    return rows.select("clip_id", "idx", *T.r6("value"))


@query("frame_signal", """
    SELECT clip_id, CAST(frame AS INTEGER) AS win, CAST(p AS INTEGER) AS pos, round(x[p + 1], 6) + 0.0 AS value
    FROM frames, range(0, 10) t(p)""", "frames")
def frame_signal(spark, d):
    return _long(T.clips(spark, d), signals.frames(F.col("samples"), G.frame, G.hop), "pos")


@query("flatten_frames", """
    SELECT clip_id, CAST(frame * 10 + p AS INTEGER) AS idx, round(x[p + 1], 6) + 0.0 AS value
    FROM frames, range(0, 10) t(p)""", "frames")
def flatten_frames(spark, d):
    flat = F.flatten(signals.frames(F.col("samples"), G.frame, G.hop))
    rows = T.clips(spark, d).select("clip_id", F.posexplode_outer(flat).alias("idx", "value"))
    return rows.select("clip_id", "idx", *T.r6("value"))


@query("short_term_windows", """
    SELECT clip_id, CAST(win AS INTEGER) AS win, CAST(p AS INTEGER) AS pos, round(v, 6) + 0.0 AS value FROM wpos""", "wpos")
def short_term_windows(spark, d):
    return _long(_windows(spark, d), F.col("windows"), "pos")


@query("zcr", WINDOWED + "f_zcr", "f_zcr")
def zcr(spark, d):
    return _windowed(_windows(spark, d), F.transform("windows", S.zero_crossing_rate))


@query("energy", WINDOWED + "f_energy", "f_energy")
def energy(spark, d):
    return _windowed(_windows(spark, d), F.transform("windows", S.mean_square))


@query("energy_entropy", WINDOWED + "f_energy_entropy", "f_energy_entropy")
def energy_entropy(spark, d):
    return _windowed(_windows(spark, d), F.transform("windows", lambda w: S.block_entropy(w)))


@query("magnitude_spectrum", """
    SELECT clip_id, CAST(win AS INTEGER) AS win, CAST(k AS INTEGER) AS bin, round(m, 6) + 0.0 AS value FROM spec""", "spec")
def magnitude_spectrum(spark, d):
    return _long(_spectra(spark, d), F.col("spectra"), "bin")


@query("spectral_centroid_spread", """
    SELECT clip_id, CAST(win AS INTEGER) AS win, round(centroid, 6) AS centroid, round(spread, 6) AS spread FROM moments""",
       "moments")
def spectral_centroid_spread(spark, d):
    rows = signals.per_window(
        _spectra(spark, d).withColumn("_v", F.transform("spectra", S.centroid_and_spread)), "_v", "m"
    )
    return rows.select("clip_id", "win", F.round("m.centroid", 6).alias("centroid"), F.round("m.spread", 6).alias("spread"))


@query("spectral_entropy", WINDOWED + "f_spectral_entropy", "f_spectral_entropy")
def spectral_entropy(spark, d):
    return _windowed(_spectra(spark, d), F.transform("spectra", lambda m: S.block_entropy(m)))


@query("spectral_flux", WINDOWED + "f_flux", "f_flux")
def spectral_flux(spark, d):
    return _windowed(_spectra(spark, d), signals.fluxes(F.col("spectra")))


@query("spectral_rolloff", WINDOWED + "f_rolloff", "f_rolloff")
def spectral_rolloff(spark, d):
    return _windowed(_spectra(spark, d), F.transform("spectra", lambda m: S.rolloff(m)))


@query("mfcc", """
    SELECT clip_id, CAST(win AS INTEGER) AS win, CAST(c - 1 AS INTEGER) AS coefficient, round(value, 6) + 0.0 AS value
    FROM f_mfcc""", "f_mfcc")
def mfcc(spark, d):
    return _long(_spectra(spark, d), F.transform("spectra", lambda m: S.cepstrum(m, G.rate, G.bins)), "coefficient")


@query("chroma", """
    SELECT clip_id, CAST(win AS INTEGER) AS win, CAST(c - 1 AS INTEGER) AS pitch_class, round(value, 6) + 0.0 AS value FROM f_chroma
    UNION ALL SELECT clip_id, CAST(win AS INTEGER), 12, round(stddev_pop(value), 6) FROM f_chroma GROUP BY clip_id, win""",
       "f_chroma")
def chroma(spark, d):
    """Twelve pitch classes, then their deviation."""
    both = F.transform(
        F.transform("spectra", lambda m: S.chroma(m, G.rate, G.bins)), lambda c: F.concat(c, F.array(S.population_std(c)))
    )
    return _long(_spectra(spark, d), both, "pitch_class")


def _named(df, names, column="matrix"):
    table = F.array(*[F.lit(n) for n in names])
    rows = signals.per_window(df, column, "_row").select("clip_id", "win", F.posexplode_outer("_row").alias("j", "value"))
    return rows.select("clip_id", "win", F.get(table, F.col("j")).alias("name"), *T.r6("value"))


@query("delta_features", """
    SELECT clip_id, CAST(win AS INTEGER) AS win, name, round(value, 6) + 0.0 AS value
    FROM (SELECT * FROM f_all UNION ALL SELECT * FROM f_delta)""", "f_all", "f_delta")
def delta_features(spark, d):
    """All 68 short-term features of every window: 34 values and their changes."""
    return _named(_matrix(spark, d), S.SHORT_TERM_NAMES)


@query("clip_feature_stats", """
    SELECT clip_id, name || '_' || stat AS name, round(value, 6) + 0.0 AS value
    FROM (SELECT clip_id, name, avg(value) AS mean, min(value) AS min, max(value) AS max, stddev_pop(value) AS std
          FROM (SELECT * FROM f_all UNION ALL SELECT * FROM f_delta) GROUP BY clip_id, name)
    UNPIVOT (value FOR stat IN (mean, min, max, std))""", "f_all", "f_delta")
def clip_feature_stats(spark, d):
    """The 272 clip features, long."""
    full = _matrix(spark, d)
    rows = signals.long_statistics(full.withColumn("features", signals.clip_statistics(F.col("matrix"))))
    return rows.select("clip_id", "name", *T.r6("value"))


view("whole_stats", """
    SELECT clip_id, name || '_' || stat AS name, value
    FROM (SELECT clip_id, name, avg(value) AS mean, min(value) AS min, max(value) AS max, stddev_pop(value) AS std
          FROM (SELECT * FROM whole_f_all UNION ALL SELECT * FROM whole_f_delta) GROUP BY clip_id, name)
    UNPIVOT (value FOR stat IN (mean, min, max, std))""", "whole_f_all", "whole_f_delta")


@query("clip_features", "SELECT clip_id, label, file_path, dataset, " + ", ".join(
    f"round(max(CASE WHEN name = '{n}' THEN value END), 6) + 0.0 AS \"{n}\"" for n in S.CLIP_FEATURE_NAMES)
    + " FROM clips JOIN whole_stats USING (clip_id) GROUP BY clip_id, label, file_path, dataset", "clips", "whole_stats")
def clip_features(spark, d):
    """The whole chain from samples: normalise, trim, frame, features, statistics; one wide row per clip."""
    out = signals.clip_features(T.dealt(T.clips(spark, d)), G)
    return out.select("clip_id", "label", "file_path", "dataset", *[
        V.rounded(F.get("features", F.lit(i))).alias(n) for i, n in enumerate(S.CLIP_FEATURE_NAMES)
    ])
