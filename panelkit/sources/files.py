"""File listings: manifest (S6) and report location."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXCEL = (".xlsx", ".XLSX", ".xls", ".XLS")  # fixed: accepted spreadsheet extensions


def file_manifest(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Name, size in MB (2 dp), modification time and parent folder of
    every file, from the binaryFile source's metadata (content is pruned)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    p = F.col("path")
    return df.select(F.element_at(F.split(p, "/"), -1).alias("nombre"),
                     F.round(F.col("length") / (1024 * 1024), 2).alias("tamano_mb"),
                     F.col("modificationTime").alias("modificado"),
                     F.element_at(F.split(p, "/"), -2).alias("carpeta"))


def locate_reports(listing: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each wanted (folder, cuadro, numero) the file to read.

    Priorities, first hit wins: 1 'Cuadro X.' , 2 'Cuadro X .', 3 the same
    case-insensitively, 4 a '-NN.' numeric suffix; only spreadsheet
    extensions.  Each file name is parsed into the (cuadro, priority) keys
    it can answer, so matching is an equi-join (no file x request pairs);
    ties inside a priority go to the smallest name (deterministic)."""
    f = listing.where(F.col("file").endswith(EXCEL[0]) | F.col("file").endswith(EXCEL[1])
                      | F.col("file").endswith(EXCEL[2]) | F.col("file").endswith(EXCEL[3]))

    def keys(regex, prio, src):
        return F.transform(F.regexp_extract_all(src, F.lit(regex), 1),
                           lambda k: F.struct(k.alias("key"), F.lit(prio).alias("prio"), F.lit(prio == 4).alias("by_num")))

    name = F.col("file")
    allk = F.concat(keys(r"Cuadro (\w+)\.", 1, name), keys(r"Cuadro (\w+) \.", 2, name),
                    keys(r"cuadro (\w+)\.", 3, F.lower(name)), keys(r"-(\w+)\.", 4, name))
    c = f.select("folder", "file", F.explode(allk).alias("_k")).select("folder", "file", "_k.*")
    exact = c.where(F.col("prio") < 3).join(wanted.select("folder", F.col("cuadro").alias("key"), "cuadro"),
                                            ["folder", "key"])
    folded = c.where(F.col("prio") == 3).join(
        wanted.select("folder", F.lower(F.col("cuadro")).alias("key"), "cuadro"), ["folder", "key"])
    by_name = exact.unionByName(folded)
    by_num = c.where(F.col("by_num")).join(
        wanted.where(F.col("numero").isNotNull()).select("folder", F.col("numero").alias("key"), "cuadro"), ["folder", "key"])
    hits = by_name.unionByName(by_num)
    best = hits.groupBy("folder", "cuadro").agg(F.min_by(F.struct("prio", "file"), F.struct("prio", "file")).alias("_b"))
    return best.select("folder", "cuadro", F.col("_b.file").alias("archivo"), F.col("_b.prio").alias("prioridad"))
