from __future__ import annotations

import hashlib
import zlib

import pytest

from registrum.llm import merkle
from tests.llm.conftest import texts

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, key string, pos int, n long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, alter=False):
    doc_id, text, lang, source, n_chars = row[:5]
    text = text.translate(UPPER) if alter and text is not None else text
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return h("".join(parts))


def tree(nodes):
    """Root, and for each node the siblings (before, after) of each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            run = at[i] // 8 * 8
            path.append(("".join(nodes[run : at[i]]), "".join(nodes[at[i] + 1 : run + 8])))
        at = [x // 8 for x in at]
        nodes = [h("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        ordered = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = (ordered, *tree([leaf(r) for r in ordered]))
    root, tops = tree([trees[x][1] for x in langs])
    out = []
    for lang, top in zip(langs, tops):
        ordered, subroot, paths = trees[lang]
        for row, path in zip(ordered, paths):
            steps = path + top
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = leaf(row, hit)
            for left, right in steps:
                node = h(left + node + right)
            out.append((row[0], leaf(row), subroot, root, h("".join(a + b for a, b in steps)), node, node == root))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in merkle.audited(df).collect()), key=str)


def rows(n, langs):
    out = [(i if i % 13 else None, t, langs[i % len(langs)], "s" if i % 5 else None, i if i % 3 else None) for i, t in enumerate(texts(4, n))]
    out += out[3:9] * 2 + [(n, "Long Text " * 30_000, langs[0], "s", 1)]
    return [(*r, "x", "y", 1, 2) for r in out]


@pytest.mark.parametrize("langs", [["en"], ["en", "en", "en", None, ""], [f"l{i}" for i in range(20)]])
def test_equal_to_brute_force(spark, langs):
    data = rows(150, langs)
    assert found(spark.createDataFrame(data, SCHEMA).repartition(5)) == brute(data)


def test_blocks_of_blocks(spark, monkeypatch):
    """Blocks of 8 leaves: the roots are appended over several levels, for languages of any size."""
    for name in ("manifest", "append_blocks", "_above", "witnesses"):
        f = getattr(merkle, name)
        monkeypatch.setattr(f, "__defaults__", tuple(1 if x == 4 else x for x in f.__defaults__ or ()) or None)
    data = rows(140, ["en", "en", "en", "en", "de", None]) + [(900 + i, "t", f"l{i}", "s", 1, "", "", 1, 1) for i in range(70)]
    assert found(spark.createDataFrame(data, SCHEMA).repartition(7)) == brute(data)


def test_tampering_is_found(spark):
    data = [(i, "Some Text" if i % 2 else "some text", "en", "s", 9, "", "", 1, 1) for i in range(40)]
    for row in merkle.audited(spark.createDataFrame(data, SCHEMA)).collect():
        altered = zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["doc_id"] % 2 == 1
        assert row["verified"] is not altered


def test_no_documents(spark):
    assert merkle.audited(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 8, 9, 63, 64, 65, 100])
def test_appender_extends_witnesses(n):
    nodes = [h(str(i)) for i in range(n)]
    assert merkle.witnesses(nodes, True) == tree(nodes)
