"""Signals to clip features, one row per clip from start to end.

A clip is a row with its samples as an array, so every step is a projection: no shuffle, no
group that could grow, and the label filter runs before any signal work.  The only non-SQL
step is the DFT, an Arrow UDF over whole record batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clipwright.functions import spectra as S, vectors as V


@dataclass(frozen=True)
class Geometry:
    """Sample counts.  At 16 kHz the published geometry is 25 ms frames with a 10 ms hop."""

    rate: int = 16000
    frame: int = 400
    hop: int = 160
    trim_frame: int = 2048
    trim_hop: int = 512

    @property
    def window(self) -> int:
        return 2 * self.frame

    @property
    def shortest(self) -> int:
        """Samples needed for one window."""
        return self.frame + self.hop

    @property
    def bins(self) -> int:
        return self.frame


def peak_normalized(samples: Column) -> Column:
    peak = F.array_max(F.transform(samples, F.abs))
    return V.bind(peak, lambda p: F.when(p > 0, V.scale(samples, 1.0 / p)).otherwise(samples))


def centred(framed: Column) -> Column:
    """Frames without the clip's mean and divided by its largest magnitude, as the feature definitions expect.

    Both are taken over the frames as flattened, so samples of overlapping frames count as often as they stand there.
    """
    def move(frames_: Column) -> Column:
        return V.bind(F.flatten(frames_), lambda x: V.bind(V.total(x) / F.size(x), lambda m: V.bind(
            F.array_max(F.transform(x, lambda s: F.abs(s - m))) + 1e-10,
            lambda p: F.transform(frames_, lambda f: F.transform(f, lambda s: (s - m) / p)))))

    return V.bind(framed, move)


def frame_count(samples: Column, frame: int, hop: int) -> Column:
    return (F.floor((F.size(samples) - frame) / hop) + 1).cast("int")


def frames(samples: Column, frame: int, hop: int) -> Column:
    """Overlapping frames; NULL for a clip shorter than one frame."""
    def cut(x: Column) -> Column:
        places = F.sequence(F.lit(0), frame_count(x, frame, hop) - 1)
        return F.when(
            F.size(x) >= frame, F.transform(places, lambda i: F.slice(x, i * hop + 1, F.lit(frame)))
        )

    return V.bind(samples, cut)


def trimmed(samples: Column, frame: int, hop: int, top_db: float = 20.0) -> Column:
    """Keep the first to the last frame within ``top_db`` of the loudest frame.

    Frames are not centred or padded.  A clip shorter than one frame, or silent, is kept whole.
    """
    share = 10.0 ** (-top_db / 10.0)

    def keep(x: Column) -> Column:
        def loud(power: Column) -> Column:
            return V.bind(
                F.array_max(power) * share,
                lambda bar: F.filter(
                    F.transform(power, lambda e, i: F.when(e > bar, i)), lambda i: i.isNotNull()
                ),
            )

        power = F.transform(frames(x, frame, hop), S.mean_square)
        return V.bind(
            V.bind(power, loud),
            lambda at: F.when(at.isNull() | (F.size(at) == 0), x).otherwise(
                F.slice(x, F.array_min(at) * hop + 1, (F.array_max(at) - F.array_min(at)) * hop + frame)
            ),
        )

    return V.bind(samples, keep)


def short_term_windows(framed: Column) -> Column:
    """Windows over the flattened frames: frame *i* followed by frame *i+1*."""
    def pair(x: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(x) - 1)
        return F.when(F.size(x) >= 2, F.transform(places, lambda i: F.concat(F.get(x, i - 1), F.get(x, i))))

    return V.bind(framed, pair)


def prepare(clips: DataFrame, g: Geometry, trim: bool = True) -> DataFrame:
    """Normalise, trim and frame; clips too short for one window are left out.

    The test needs only the number of samples, so it runs before any signal work.
    """
    if trim and g.trim_frame < g.shortest:
        raise ValueError("a trimmed clip could be shorter than one window")
    out = clips.where(F.size("samples") >= g.shortest).withColumn("samples", peak_normalized(F.col("samples")))
    if trim:
        out = out.withColumn("samples", trimmed(F.col("samples"), g.trim_frame, g.trim_hop))
    return out.withColumn("frames", frames(F.col("samples"), g.frame, g.hop))


def with_windows(clips: DataFrame, g: Geometry) -> DataFrame:
    """Add ``windows`` of each clip's centred frames; clips with no window are left out."""
    long_enough = clips.where(F.size("samples") >= g.shortest)
    framed = centred(frames(F.col("samples"), g.frame, g.hop))
    return V.fenced(long_enough, "windows", short_term_windows(framed))


def with_spectra(windowed: DataFrame, g: Geometry) -> DataFrame:
    return windowed.withColumn("spectra", S.magnitude_spectra(g.window)(F.col("windows")))


def per_window(df: DataFrame, column: str, name: str = "value", keys=("clip_id",)) -> DataFrame:
    """Array per clip -> rows (keys..., win, value).

    The outer form keeps the optimizer from evaluating the array a second time in a size filter.
    """
    return df.select(*keys, F.posexplode_outer(column).alias("win", name)).where(F.col("win").isNotNull())


def fluxes(spectra: Column) -> Column:
    """Flux of each window against the one before; the first has none."""
    return V.bind(
        spectra,
        lambda x: F.transform(
            x, lambda m, i: F.when(i == 0, F.lit(0.0)).otherwise(S.flux(m, F.get(x, i - 1)))
        ),
    )


def short_term_matrix(windows: Column, spectra: Column, g: Geometry) -> Column:
    """Array of windows, each an array of the 34 base features."""

    def features(w: Column, m: Column, change: Column) -> Column:
        head = V.bind(
            S.centroid_and_spread(m),
            lambda c: F.array(
                S.zero_crossing_rate(w), S.mean_square(w), S.block_entropy(w),
                c["centroid"], c["spread"], S.block_entropy(m), change, S.rolloff(m),
            ),
        )
        pitch = V.bind(S.chroma(m, g.rate, g.bins), lambda c: F.concat(c, F.array(S.population_std(c))))
        return F.concat(head, S.cepstrum(m, g.rate, g.bins), pitch)

    rows = F.arrays_zip(windows.alias("w"), spectra.alias("m"), fluxes(spectra).alias("c"))
    return F.transform(rows, lambda r: features(r["w"], r["m"], r["c"]))


def with_deltas(matrix: Column) -> Column:
    """Append the change of every feature since the previous window; zero in the first window."""
    def change(x: Column) -> Column:
        return F.transform(
            x,
            lambda row, i: F.concat(
                row,
                F.when(i == 0, F.transform(row, lambda v: v * 0.0)).otherwise(V.subtract(row, F.get(x, i - 1))),
            ),
        )

    return V.bind(matrix, change)


def clip_statistics(matrix: Column) -> Column:
    """Mean, minimum, maximum and population deviation of each feature over the windows.

    All means come first, then all minima, maxima and deviations.
    """
    def series(x: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(F.get(x, F.lit(0))) - 1)
        return F.transform(places, lambda j: F.transform(x, lambda row: F.get(row, j)))

    def statistics(s: Column) -> Column:
        return F.concat(
            F.transform(s, lambda v: V.total(v) / F.size(v)),
            F.transform(s, F.array_min),
            F.transform(s, F.array_max),
            F.transform(s, S.population_std),
        )

    return V.bind(V.bind(matrix, series), statistics)


def clip_features(clips: DataFrame, g: Geometry, trim: bool = True) -> DataFrame:
    """Clips to ``features``: 272 numbers named by ``spectra.CLIP_FEATURE_NAMES``."""
    ready = prepare(clips, g, trim)
    flat = V.fenced(ready, "windows", short_term_windows(centred(F.col("frames"))))
    spectral = with_spectra(flat, g)
    matrix = with_deltas(short_term_matrix(F.col("windows"), F.col("spectra"), g))
    rest = spectral.drop("samples", "frames")
    return V.fenced(rest, "features", clip_statistics(matrix)).drop("windows", "spectra")


def long_statistics(features: DataFrame, names: list[str] | None = None, keys=("clip_id",)) -> DataFrame:
    """Rows (keys..., name, value) of an array of features."""
    table = F.array(*[F.lit(n) for n in (names or S.CLIP_FEATURE_NAMES)])
    return features.select(*keys, F.posexplode_outer("features").alias("_j", "value")).select(
        *keys, F.get(table, F.col("_j")).alias("name"), "value"
    )
