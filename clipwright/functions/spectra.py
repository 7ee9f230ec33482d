"""Column functions for short-term signal features.

A *window* is an ``array<double>`` of samples, a *spectrum* is the array of its
DFT magnitudes.  Formulas follow the published short-term feature definitions
(Giannakopoulos 2015; Davis and Mermelstein 1980 for the cepstrum).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from clipwright.functions import vectors as V

# Fixed values of the published definitions.
EPS = 1e-8
ENTROPY_BLOCKS = 10
ROLLOFF_SHARE = 0.90
LOWEST_FILTER_HZ = 133.33
LINEAR_SPACING_HZ = 200.0 / 3.0
LOG_SPACING = 1.0711703
LINEAR_FILTERS = 13
LOG_FILTERS = 27
LOG_FILTERS_LOW_RATE = 5
LOW_RATE_HZ = 8000
CEPSTRA = 13
TUNING_HZ = 27.5
PITCH_CLASSES = 12

BASE_NAMES = (
    ["zcr", "energy", "energy_entropy", "spectral_centroid", "spectral_spread",
     "spectral_entropy", "spectral_flux", "spectral_rolloff"]
    + [f"mfcc_{i}" for i in range(1, CEPSTRA + 1)]
    + [f"chroma_{i}" for i in range(1, PITCH_CLASSES + 1)]
    + ["chroma_std"]
)
SHORT_TERM_NAMES = BASE_NAMES + [f"delta {n}" for n in BASE_NAMES]
STATISTICS = ["mean", "min", "max", "std"]
CLIP_FEATURE_NAMES = [f"{n}_{s}" for s in STATISTICS for n in SHORT_TERM_NAMES]


# ---- time domain -------------------------------------------------------------------

def zero_crossing_rate(window: Column) -> Column:
    steps = F.size(window) - 1
    turns = F.zip_with(
        F.slice(window, F.lit(2), steps),
        F.slice(window, F.lit(1), steps),
        lambda now, before: F.abs(F.signum(now) - F.signum(before)),
    )
    return V.total(turns) / 2.0 / steps


def mean_square(window: Column) -> Column:
    return V.square_sum(window) / F.size(window)


def block_entropy(values: Column, blocks: int = ENTROPY_BLOCKS) -> Column:
    """Entropy (bits) of the energy shares of ``blocks`` equal blocks; a remainder is left out."""
    length = F.floor(F.size(values) / blocks).cast("int")
    blocks_of = F.transform(
        F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: V.square_sum(F.slice(values, b * length + 1, length))
    )

    def entropy(whole: Column) -> Column:
        return F.aggregate(
            F.transform(blocks_of, lambda e: e / whole), F.lit(0.0), lambda acc, s: acc - s * F.log2(s + EPS)
        )

    return V.bind(V.square_sum(values) + EPS, entropy)


# ---- spectrum ----------------------------------------------------------------------

def magnitude_spectra(window_length: int):
    """Arrow UDF: the windows of each clip -> first half of the DFT magnitudes, scaled by its size.

    All windows of a record batch go through one vectorised FFT call.  Null clips stay null.
    """
    half = window_length // 2

    @F.arrow_udf("array<array<double>>")
    def spectra(clips: pa.Array) -> pa.Array:
        windows = clips.flatten()
        samples = windows.flatten().to_numpy(zero_copy_only=False).reshape(-1, window_length)
        magnitudes = np.abs(np.fft.rfft(samples, axis=1))[:, :half] / half
        rows = pa.ListArray.from_arrays(
            pa.array(np.arange(len(magnitudes) + 1, dtype=np.int32) * half),
            pa.array(magnitudes.ravel()),
        )
        counts = np.nan_to_num(clips.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), rows, mask=clips.is_null())

    return spectra


def centroid_and_spread(spectrum: Column) -> Column:
    """Struct of the first and second spectral moment as shares of the Nyquist frequency."""
    bins = F.size(spectrum)
    peak = F.array_max(spectrum)

    def moments(weights: Column) -> Column:
        centroid = V.total(F.transform(weights, lambda w, i: w * (i + 1) / bins)) / (V.total(weights) + EPS)

        def around(c: Column) -> Column:
            away = F.transform(weights, lambda w, i: w * ((i + 1) / bins - c) * ((i + 1) / bins - c))
            return F.struct(
                c.alias("centroid"), F.sqrt(V.total(away) / (V.total(weights) + EPS)).alias("spread")
            )

        return V.bind(centroid, around)

    weights = V.bind(
        F.when(peak == 0, F.lit(EPS)).otherwise(peak), lambda top: F.transform(spectrum, lambda m: m / top)
    )
    return V.bind(weights, moments)


def flux(spectrum: Column, previous: Column) -> Column:
    def mass(m: Column) -> Column:
        return V.total(m) + F.size(m) * F.lit(EPS)

    def change(sums: Column) -> Column:
        return V.square_sum(F.zip_with(spectrum, previous, lambda a, b: a / sums["now"] - b / sums["before"]))

    return V.bind(F.struct(mass(spectrum).alias("now"), mass(previous).alias("before")), change)


def rolloff(spectrum: Column, share: float = ROLLOFF_SHARE) -> Column:
    """Lowest bin (as a share of the bins) at which the running energy passes ``share`` of the whole."""
    start = F.struct(F.lit(0.0).alias("energy"), F.lit(0).alias("below"))
    def walk(bar: Column) -> Column:
        return F.aggregate(
            spectrum,
            start,
            lambda acc, m: F.struct(
                (acc["energy"] + m * m).alias("energy"),
                (acc["below"] + F.when(acc["energy"] + m * m + EPS > bar, 0).otherwise(1)).alias("below"),
            ),
            lambda acc: F.when(acc["below"] >= F.size(spectrum), 0.0).otherwise(acc["below"] / F.size(spectrum)),
        )

    return V.bind(V.square_sum(spectrum) * share, walk)


# ---- cepstrum and pitch classes ----------------------------------------------------

def filter_rows(rate: int, bins: int) -> list[tuple[int, list[float]]]:
    """The triangular filter bank as (first bin, weights); bins past the spectrum are cut off."""
    log_filters = LOG_FILTERS_LOW_RATE if rate < LOW_RATE_HZ else LOG_FILTERS
    edges = [LOWEST_FILTER_HZ + i * LINEAR_SPACING_HZ for i in range(LINEAR_FILTERS)]
    edges += [edges[-1] * LOG_SPACING**i for i in range(1, log_filters + 3)]
    rows = []
    for low, centre, high in zip(edges, edges[1:], edges[2:]):
        first = math.floor(low * bins / rate) + 1
        turn = math.floor(centre * bins / rate) + 1
        last = math.floor(high * bins / rate)
        height = 2.0 / (high - low)
        weights = []
        for b in range(first, min(last, bins - 1) + 1):
            hertz = b * rate / bins
            rise = height / (centre - low) * (hertz - low)
            fall = height / (high - centre) * (high - hertz)
            weights.append(rise if b < turn else fall)
        rows.append((min(first, bins), weights))
    return rows


def cosine_rows(filters: int) -> list[list[float]]:
    """Rows of the orthonormal DCT-II, one per cepstral coefficient."""
    return [
        [
            math.sqrt((1.0 if k == 0 else 2.0) / filters) * math.cos(math.pi * k * (2 * j + 1) / (2 * filters))
            for j in range(filters)
        ]
        for k in range(CEPSTRA)
    ]


def cepstrum(spectrum: Column, rate: int, bins: int) -> Column:
    """13 cepstral coefficients; each filter touches only the bins under its triangle."""
    bank = filter_rows(rate, bins)
    energies = F.array(*[
        F.log10((V.dot(F.slice(spectrum, first + 1, len(w)), V.literal(w)) if w else F.lit(0.0)) + EPS)
        for first, w in bank
    ])
    cosines = V.literal_matrix(cosine_rows(len(bank)))
    return V.bind(energies, lambda e: F.transform(cosines, lambda row: V.dot(row, e)))


def pitch_bins(rate: int, bins: int) -> list[tuple[int, float]]:
    """For each bin its pitch class and the weight 1 / (bins on the same semitone)."""
    semitones = [round(12.0 * math.log2((b + 1) * rate / (2.0 * bins) / TUNING_HZ)) for b in range(bins)]
    return [(s % PITCH_CLASSES, 1.0 / semitones.count(s)) for s in semitones]


def chroma(spectrum: Column, rate: int, bins: int) -> Column:
    """Energy share of the 12 pitch classes."""
    table = pitch_bins(rate, bins)
    energy = V.square_sum(spectrum)

    def share(pitch_class: int, whole: Column) -> Column:
        terms = [
            F.element_at(spectrum, b + 1) * F.element_at(spectrum, b + 1) * w
            for b, (c, w) in enumerate(table)
            if c == pitch_class
        ]
        return (sum(terms[1:], terms[0]) / whole) if terms else F.lit(0.0)

    return V.bind(
        energy,
        lambda e: V.bind(
            F.when(e == 0, F.lit(EPS)).otherwise(e),
            lambda whole: F.array(*[share(c, whole) for c in range(PITCH_CLASSES)]),
        ),
    )


def population_std(values: Column) -> Column:
    """Population standard deviation of the elements of one array."""
    return V.bind(
        V.total(values) / F.size(values),
        lambda m: F.sqrt(
            F.aggregate(values, F.lit(0.0), lambda acc, v: acc + (v - m) * (v - m)) / F.size(values)
        ),
    )
