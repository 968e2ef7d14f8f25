from __future__ import annotations

import re
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from reviewlab.operators import hygiene


def by_hand(text: str, letters=hygiene.MARKED_LETTERS, patterns=hygiene.WORD_PATTERNS):
    words = re.compile("|".join(rf"\b(?:{p})\b" for p in patterns), re.IGNORECASE)
    for number, line in enumerate(text.splitlines(), start=1):
        if any(ch in letters for ch in line):
            yield number, "diacritic", line.rstrip()
        elif words.search(line):
            yield number, "keyword", line.rstrip()


def scanned(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return sorted(tuple(r) for r in hygiene.scan_lines(df, ["i"], **options).collect())


def expected(texts, **options):
    return sorted((i, *f) for i, t in enumerate(texts) for f in by_hand(t, **options))


# One text per pattern: a phrase it stands for, with plain spaces.
EXAMPLES = [
    re.sub(r"\(.*\|(\w+)\)", r"\1", p.replace("s?", "s").replace(r"\s+", "  "))
    for p in hygiene.WORD_PATTERNS
]


def test_every_pattern_and_letter_is_found(spark):
    texts = [*(f"x {w.upper()}, y" for w in EXAMPLES), *hygiene.MARKED_LETTERS]
    got = scanned(spark, texts)
    assert got == expected(texts)
    assert len(got) == len(texts) == 53 + 28


def test_words_are_whole_and_lines_have_one_finding(spark):
    texts = [
        "naomi nao_x xnao 2nao nao2 única",
        "the nao über",
        "übernao naoß",
        "senha e versão",
        "nao\nok\r\nfuturo  \t\n\nporque",
        "a\x0bnao\x0c\x1cfuturo\x85senha x porque   minimo　",
        "toda segunda e toda semana",
        "",
        "ſenha",
        "linha\u00a0de\u3000comando",
        "toda\u2009\tsexta",
    ]
    assert scanned(spark, texts) == expected(texts)


def test_letters_are_taken_literally(spark):
    texts = ["a]b", "a^b", "a-b", "plain", "b"]
    options = {"letters": "^-]", "patterns": ("plain",)}
    assert scanned(spark, texts, **options) == expected(texts, **options)


def test_whole_tables_as_by_hand(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    options = {"letters": "äöüßÄÖÜ", "patterns": (r"und", r"nicht", r"d(er|ie|as)\s+\w+")}
    texts = {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    for chosen in ({}, options):
        got = sorted(tuple(r) for r in hygiene.scan_lines(df, ["doc_id"], **chosen).collect())
        want = sorted((i, *f) for i, t in texts.items() for f in by_hand(t, **chosen))
        assert got == want and got


def test_report_and_summary(spark):
    df = spark.createDataFrame([("x" * 120,), ("y" * 121,)], "content string")
    shown = [r[0] for r in df.select(hygiene.shown(F.col("content"))).collect()]
    assert shown == ["x" * 120, "y" * 117 + "..."]
    found = spark.createDataFrame([("keyword",), ("keyword",), ("diacritic",)], "kind string")
    assert dict(hygiene.summary(found).collect()) == {"keyword": 2, "diacritic": 1}
    assert not hygiene.is_clean(found)
    assert hygiene.is_clean(found.limit(0))


NAMES = [
    *("a.py", "b.txt", ".py", "c.tar.md", "Makefile", "makefile", "self.py", "d."),
    "e.tfvars.example",
]


def test_scope_by_name(spark):
    df = spark.createDataFrame([(f"file:/r/{n}",) for n in NAMES], "path string")
    scope = hygiene.in_scope(F.col("path"), excluded=["self.py"])
    got = {PurePosixPath(r["path"]).name for r in df.where(scope).collect()}
    want = {
        n
        for n in NAMES
        if n != "self.py" and (n in hygiene.NAMES or PurePosixPath(n).suffix in hygiene.SUFFIXES)
    }
    assert got == want == {"a.py", "c.tar.md", "Makefile", "e.tfvars.example"}


@pytest.mark.parametrize("excluded", [(), ("b.md",)])
def test_tree_of_files(spark, tmp_path, excluded):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.py").write_text("ok\nx = 'senha'\n", encoding="utf-8")
    (tmp_path / "deep" / "b.md").write_text("não\n", encoding="utf-8")
    (tmp_path / "c.txt").write_text("não\n", encoding="utf-8")
    (tmp_path / "bad.py").write_bytes(b"nao \xff\xfe\n")
    rows = hygiene.scan_files(spark, str(tmp_path), excluded=excluded).collect()
    got = {(PurePosixPath(r["path"]).name, r["line_no"], r["kind"], r["content"]) for r in rows}
    want = {("a.py", 2, "keyword", "x = 'senha'"), ("b.md", 1, "diacritic", "não")}
    assert got == {w for w in want if w[0] not in excluded}
