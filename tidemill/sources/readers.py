"""Sources: a registry of named data sets, ingestion of JSON lines, discovery of finished files."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Source:
    """A data set: where its parts lie, by configuration or split, and its schema where inference fails. Downloads are not part of an engine without a network: paths name what is there."""

    name: str
    paths: dict[str, str]
    format: str = "parquet"
    schema: T.StructType | str | None = None
    part_column: str = "config"
    options: dict[str, str] = field(default_factory=dict)


class Registry:
    """Sources by name."""

    def __init__(self) -> None:
        self.sources: dict[str, Source] = {}

    def add(self, source: Source) -> Registry:
        self.sources[source.name] = source
        return self

    def read(self, spark: SparkSession, name: str, parts: list[str] | None = None, most: int | None = None, pos: str | None = None) -> DataFrame:
        """All parts, or some, as one table with its part's name; `most` rows of it in the order of `pos`."""
        s = self.sources[name]
        unknown = set(parts or []) - set(s.paths)
        if unknown:
            raise KeyError(f"{name} has no {sorted(unknown)}")
        frames = []
        for part, path in s.paths.items():
            if parts is None or part in parts:
                r = spark.read.format(s.format).options(**s.options)
                frames.append((r.schema(s.schema) if s.schema else r).load(path).withColumn(s.part_column, F.lit(part)))
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return df if most is None else (df.orderBy(pos) if pos else df).limit(most)


# Public data sets by the kind of corpus, with their configurations or splits.
CHAT_SETS = {
    "open-thoughts/OpenThoughts3-1.2M": ["train"],
    "allenai/Dolci-Think-SFT-7B": ["train"],
    "PrimeIntellect/SYNTHETIC-2-SFT-verified": ["train"],
    "open-r1/Mixture-of-Thoughts": ["math", "code", "science"],
    "nvidia/Nemotron-Math-Proofs-v1": [],
    "nvidia/Nemotron-Competitive-Programming-v1": ["competitive_coding_cpp_part00", "competitive_coding_cpp_part01", "competitive_coding_python_part00", "competitive_coding_python_part01", "infinibyte_part00", "infinibyte_part01"],
    "nvidia/Nemotron-Math-v2": ["low", "medium", "high_part00", "high_part01", "high_part02"],
    "a-m-team/AM-DeepSeek-R1-Distilled-1.4M": ["am_0.5M", "am_0.9M", "am_0.9M_sample_1k"],
    "nvidia/Llama-Nemotron-Post-Training-Dataset": ["code", "math", "science", "chat", "safety"],
    "nvidia/Nemotron-Post-Training-Dataset-v2": ["math", "code", "stem", "chat", "multilingual_ja", "multilingual_de", "multilingual_it", "multilingual_es", "multilingual_fr"],
}
REWARD_SETS = {
    "allenai/Dolci-Think-RL-7B": ["train"],
    "allenai/Dolci-Instruct-RL": ["train"],
    "a-m-team/AM-Thinking-v1-RL-Dataset": ["train"],
    "nvidia/Llama-Nemotron-Post-Training-Dataset": ["train"],
    "nvidia/Nemotron-3-Nano-RL-Training-Blend": ["train"],
    "nvidia/Nemotron-RL-ReasoningGym-v1": ["train"],
    "PrimeIntellect/SYNTHETIC-2-RL": ["train"],
    "MiniMaxAI/SynLogic": ["train"],
    "TIGER-Lab/WebInstruct-verified": ["train"],
    "CLUTRR/v1": ["train"],
    "logicreasoning/logi_glue": ["train"],
}


def folder_of(name: str) -> str:
    """A data set's folder: its name, the slash as two underscores."""
    return name.replace("/", "__")


def found_parts(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders below one, in order, in any store Spark reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(conf)
    return sorted(s.getPath().getName() for s in fs.listStatus(base) if s.isDirectory()) if fs.exists(base) else []


def public_registry(spark: SparkSession, root: str, sets: dict[str, list[str]] | None = None) -> Registry:
    """The public data sets that lie below `root`, a folder for each and in it one for each part. Sets whose parts are not listed have those that are there; a set without any is left out."""
    out = Registry()
    for name, parts in (sets if sets is not None else CHAT_SETS | REWARD_SETS).items():
        at = f"{root}/{folder_of(name)}"
        there = found_parts(spark, at)
        mine = [p for p in there if p in parts] if parts else there
        if mine:
            out.add(Source(name, {p: f"{at}/{p}" for p in mine}))
    return out


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    """The first path that is there, in any store Spark reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            return p
    raise FileNotFoundError(", ".join(paths))


def json_lines(spark: SparkSession, path: str, columns: dict[str, str], as_text: tuple[str, ...] = ()) -> DataFrame:
    """JSON lines with these columns and types; `as_text`: nested ones that stay JSON text, whatever they hold. Lines that are no JSON give a null row with the line in `_corrupt`."""
    lines = spark.read.text(path)
    schema = ", ".join(f"`{n}` {t}" for n, t in columns.items() if n not in as_text)
    ok = F.try_parse_json("value").isNotNull()
    parsed = F.from_json("value", schema) if schema else F.lit(None)
    flat = [parsed[n].alias(n) for n in columns if n not in as_text] + [F.get_json_object("value", f"$['{n}']").alias(n) for n in as_text]
    return lines.select(*flat, F.when(~ok, F.col("value")).alias("_corrupt"))


def positioned(df: DataFrame, pos: str = "pos") -> DataFrame:
    """`df` with its rows' places: files in order of name, rows in order within each.

    The place comes from the file, not from how it was split, so a task that runs anew gives the same. A table that has a column of this name keeps it; rows that come from no
    file are numbered as they are dealt out. A list of file names is broadcast, one row for each file.
    """
    if pos in df.columns:
        return df
    files = sorted(df.inputFiles())
    if not files:
        return df.withColumn(pos, F.monotonically_increasing_id())
    names = df.sparkSession.createDataFrame(list(enumerate(files)), "_n long, _f string")
    try:
        x = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException as e:
        raise ValueError(f"rows that are not read straight from files need a column {pos}") from e
    same = F.regexp_replace("_f", "^file:/+", "/") == F.regexp_replace("_file", "^file:/+", "/")
    return x.join(F.broadcast(names), same).withColumn(pos, F.shiftleft("_n", 40) + F.col("_row")).drop("_file", "_row", "_n", "_f")


def skip_and_limit(df: DataFrame, pos: str, skip: int = 0, most: int | None = None) -> DataFrame:
    """Rows from a position on, at most so many."""
    x = df.filter(F.col(pos) >= skip)
    return x if most is None else x.orderBy(pos).limit(most)


def finished_files(spark: SparkSession, root: str, suffix: str = ".kept.parquet", exclude_prefix: str = "merged_") -> list[str]:
    """Paths of finished outputs in a folder and one level below, in order of name."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(conf)
    found = []
    for pattern in (f"{root}/*{suffix}", f"{root}/*/*{suffix}"):
        for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(pattern)) or []:
            if not s.getPath().getName().startswith(exclude_prefix):
                found.append(s.getPath().toString())
    return sorted(found)
