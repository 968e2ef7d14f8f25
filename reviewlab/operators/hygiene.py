"""Lines of text in a language they should not be in.

Lines come from exploding each text where it lies; nothing is shuffled until the
findings, one short row each, are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What counts as Portuguese. Letters first, then whole words and
# phrases (patterns, any case) that English does not have.
MARKED_LETTERS = "áéíóúâêîôûãõàçÁÉÍÓÚÂÊÎÔÛÃÕÀÇ"
WORD_PATTERNS = (
    r"usadas?",
    r"usados?",
    r"sera",
    r"serao",
    r"geradas?",
    r"gerados?",
    r"compactadas?",
    r"compactados?",
    r"substitui",
    r"adicionado",
    r"adicionada",
    r"removido",
    r"removida",
    r"modulo",
    r"modulos",
    r"variavel",
    r"variaveis",
    r"execucao",
    r"versao",
    r"versoes",
    r"regiao",
    r"regioes",
    r"pacote",
    r"pacotes",
    r"arquivo",
    r"arquivos",
    r"senha",
    r"reproduzivel",
    r"reproduziveis",
    r"minimo",
    r"minima",
    r"configuravel",
    r"configuraveis",
    r"moderno",
    r"moderna",
    r"recomendado",
    r"recomendada",
    r"opcional",
    r"necessario",
    r"necessaria",
    r"proprio",
    r"propria",
    r"nao",
    r"tambem",
    r"porque",
    r"entao",
    r"futuro",
    r"path_dados",
    r"linha\s+de\s+comando",
    r"comentar\s+resultados",
    r"cancela\s+runs",
    r"falha\s+o\s+ci",
    r"toda\s+(segunda|terca|quarta|quinta|sexta)",
)
# Which files are looked at, by name.
SUFFIXES = (
    ".py",
    ".tf",
    ".tfvars",
    ".sh",
    ".bash",
    ".md",
    ".yml",
    ".yaml",
    ".toml",
    ".cfg",
    ".ini",
    ".json",
    ".example",
)
NAMES = ("Makefile", "Dockerfile")
# A finding is shown up to SHOWN characters, else cut to CUT and dots.
SHOWN = 120
CUT = 117

# Every line end that text tools know, as a pattern; CR LF is one end.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
BLANKS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
BLANK_CLASS = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in BLANKS) + "]"
WORD_CHAR = r"[\p{L}\p{N}_]"


def lines_of(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``keys, line_no, line``, numbered from 1 within each text."""
    return df.select(*keys, F.posexplode(F.split(F.col(text), LINE_END))).select(
        *keys,
        (F.col("pos") + 1).cast("bigint").alias("line_no"),
        F.col("col").alias("line"),
    )


def finding_kind(
    line: Column, letters: str = MARKED_LETTERS, patterns: Sequence[str] = WORD_PATTERNS
) -> Column:
    """``diacritic``, else ``keyword``, else null: at most one finding per line.

    Word bounds and blanks are spelled out, as ``\\b`` and ``\\s`` differ between
    engines in what they take for a letter and for a blank.
    """
    spelled = "|".join(patterns).replace(r"\s", BLANK_CLASS)
    words = f"(?iu)(?<!{WORD_CHAR})(?:{spelled})(?!{WORD_CHAR})"
    marked = rf"[\Q{letters}\E]"
    return F.when(line.rlike(marked), "diacritic").when(line.rlike(words), "keyword")


def scan_lines(
    df: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    *,
    letters: str = MARKED_LETTERS,
    patterns: Sequence[str] = WORD_PATTERNS,
) -> DataFrame:
    """``keys, line_no, kind, content``, one row per line with a finding."""
    return (
        lines_of(df, keys, text)
        .withColumn("kind", finding_kind(F.col("line"), letters, patterns))
        .where(F.col("kind").isNotNull())
        .select(
            *keys, "line_no", "kind", F.rtrim(F.col("line"), F.lit(BLANKS)).alias("content")
        )
    )


def shown(content: Column) -> Column:
    """The content as a report prints it."""
    return F.when(
        F.length(content) > SHOWN, F.concat(F.substring(content, 1, CUT), F.lit("..."))
    ).otherwise(content)


def summary(findings: DataFrame) -> DataFrame:
    """Findings per kind."""
    return findings.groupBy("kind").agg(F.count(F.lit(1)).alias("findings"))


def is_clean(findings: DataFrame) -> bool:
    """The verdict; stops at the first finding."""
    return findings.isEmpty()


def in_scope(
    path: Column,
    *,
    suffixes: Sequence[str] = SUFFIXES,
    names: Sequence[str] = NAMES,
    excluded: Sequence[str] = (),
) -> Column:
    """By file name: never an excluded one, always a listed one, else by last suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    suffix = F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)
    wanted = name.isin(*names) | suffix.isin(*suffixes)
    return wanted & ~name.isin(*excluded) if excluded else wanted


def scan_files(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    suffixes: Sequence[str] = SUFFIXES,
    names: Sequence[str] = NAMES,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """``path, line_no, kind, content`` over a tree of text files.

    Line numbers need a file in one piece, so this suits source trees; Spark refuses
    a file of 2 GB. The filter on names prunes the file list, so other files are not
    opened. Files that are not UTF-8 are passed over.
    """
    name = F.col("_metadata.file_name")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path if isinstance(path, str) else list(path))
        .where(in_scope(name, suffixes=suffixes, names=names, excluded=excluded))
        .where(F.is_valid_utf8(F.col("content").cast("string")))
        .select("path", F.col("content").cast("string").alias("text"))
    )
    return scan_lines(files, ["path"])
