"""Named providers of detections and readers of text: a registry, and rules for what may be used."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: name: (builder(spark, **settings) -> detections, settings that must be given, whether a release may use it)
PROVIDERS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...], bool]] = {}
READERS: dict[str, Callable[[bytes], str]] = {}
SETTINGS = {"tag_review_below": "0.8", "scale": "", "level_default_m": "3.0"}


def provider(name: str, needs: tuple[str, ...] = (), release: bool = True):
    def register(f):
        PROVIDERS[name] = (f, needs, release)
        return f

    return register


def detect(spark: SparkSession, config: dict, release: bool = False) -> DataFrame:
    """The detections of the configured provider; unknown names, missing settings and unlicensed providers are errors."""
    name = config.get("provider")
    if name not in PROVIDERS:
        raise KeyError(f"unknown provider {name!r}; there are {sorted(PROVIDERS)}")
    build, needs, may = PROVIDERS[name]
    missing = [k for k in needs if not config.get(k)]
    if missing:
        raise ValueError(f"{name} needs {missing}")
    if release and not may:
        raise PermissionError(f"{name} may not be used in a release")
    return build(spark, **{k: v for k, v in config.items() if k != "provider"})


@provider("precomputed", ("path",))
def _precomputed(spark: SparkSession, path: str, **_) -> DataFrame:
    return spark.read.parquet(path)


@provider("combined", ("parts",))
def _combined(spark: SparkSession, parts: list[dict], **_) -> DataFrame:
    """Several providers' detections, one after the other."""
    out = None
    for p in parts:
        d = detect(spark, p)
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


@provider("labeled", ("inner", "labels"))
def _labeled(spark: SparkSession, inner: dict, labels: list[str], **_) -> DataFrame:
    """Another provider's detections of some labels."""
    return detect(spark, inner).where(F.col("label").isin(labels))


def settings(project: dict | None = None, explicit: dict | None = None) -> dict[str, str]:
    """Explicit over project over default; unknown names are errors."""
    for layer in (project or {}, explicit or {}):
        unknown = set(layer) - set(SETTINGS)
        if unknown:
            raise KeyError(f"unknown settings: {sorted(unknown)}")
    return {**SETTINGS, **(project or {}), **(explicit or {})}


def read_texts(images: DataFrame, reader: str | None, content: str = "content") -> DataFrame:
    """images with text by a registered reader; without one, text is null."""
    f = READERS.get(reader or "")
    if f is None:
        return images.withColumn("text", F.lit(None).cast("string"))

    @F.pandas_udf("string")
    def run(s):
        return s.map(lambda b: None if b is None else f(bytes(b)))

    return images.withColumn("text", run(content))
