"""Packed token files, runs of words and the Merkle manifest against brute-force versions."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridsight.llm import merkle, packed, runs
from gridsight.llm.shared import folder, table

EXTRA = "doc_id bigint, text string, source string, lang string, n_chars bigint, ids string, runs int, start int, node string, path string, payload string, g int, k0 int, t string, m map<string,int>"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def frame(spark, rows, source="s"):
    return spark.createDataFrame([(i, t, source, "en", 7, "x", 1, 2, "n", "p", "q", 3, 4, "u", {"a": 1}) for i, t in rows], EXTRA)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab cd efg Hij é 漢字 42".split()) for _ in range(rng.randrange(200)))) for i in range(60)]
    return rows + [(7, None), (8, ""), (9, " \n\t "), (None, "no id"), (None, None), (3, rows[3][1]), (3, rows[3][1]), (3, "other"), (-4, "neg <|endoftext|> é"), (99, "ab " * 200_000)]


# -- packed ids


@pytest.mark.parametrize("width", [1, 5, 15, 16, 17, 31, 32])
def test_pack_and_unpack(width):
    rng = np.random.default_rng(width)
    for n in (0, 1, 63, 64, 65, 70_000):
        ids = rng.integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
        data = packed.pack(ids, width)
        assert len(data) == -(-n // 64) * 8 * width and (packed.unpack(data, n, width) == ids).all()
    with pytest.raises(ValueError):
        packed.pack(np.array([1 << width], np.uint64), width) if width < 32 else packed.bits_for(0)


def test_bits():
    assert [packed.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_packed_files(spark, odd_rows):
    path = folder(spark, "packed")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    packed.write_packed(frame(spark, odd_rows).repartition(5), path, TOKENIZER, 50257)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = packed.read_packed(spark, path).collect()
    tool = Tokenizer.from_file(TOKENIZER)
    tool.encode_special_tokens = True
    want = collections.Counter((i, tuple(tool.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in odd_rows)
    whole, at = [], 0
    for r in sorted(got, key=lambda r: r["start"]):
        ids = np.frombuffer(r["ids"], "<u4")
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        at += len(ids)
        whole.append((r["doc_id"], tuple(ids.tolist())))
    assert collections.Counter(whole) == want
    order = [(i is not None, i or 0) for i, _ in whole]
    assert order == sorted(order)
    flat = [x for _, ids in whole for x in ids]
    rng = random.Random(1)
    for a, n in [(0, len(flat)), (len(flat) - 3, 99), *[(rng.randrange(len(flat)), rng.randrange(90_000)) for _ in range(20)]]:
        assert packed.read_ids(path, a, n).tolist() == flat[a : a + n]
    head = packed.manifest(path)
    assert (head["bits"], head["ids"], len(head["files"]) > 1) == (16, len(flat), True)


def test_packed_files_of_bounded_size(spark):
    """A new file begins when one is full; a lost attempt's file is not read."""
    path = folder(spark, "packed")
    writer, system = packed.PackedWriter(path, 50257), packed._filesystem(path)[0]
    spark.range(1).count()
    system.create_dir(path, recursive=True)
    stray = packed.FileWriter(system, f"{path}/part-000000-0000-stray.ids", 16)
    stray.add(1, np.arange(5, dtype=np.uint32))
    files = [stray.close()]
    other = packed.FileWriter(system, f"{path}/part-000001-0000-lost.ids", 16)
    other.add(2, np.arange(9, dtype=np.uint32))
    other.close()
    writer.commit([packed.Written(0, files)])
    assert [r["doc_id"] for r in packed.read_packed(spark, path).collect()] == [1]
    with pytest.raises(ValueError):
        with system.open_output_stream(f"{path}/short.ids") as f:
            f.write(b"x" * 100)
        packed.FileReader(system, f"{path}/short.ids")


def test_packed_empty_table(spark):
    path = folder(spark, "packed")
    packed.write_packed(frame(spark, []), path, TOKENIZER, 50257)
    assert packed.read_packed(spark, path).count() == 0 and packed.read_ids(path, 0, 10).tolist() == []


# -- runs


def brute_runs(x):
    out = {}
    for p in range(1, len(x) // 4 + 1):
        i = 0
        while i + p < len(x):
            j = i
            while j + p < len(x) and x[j] == x[j + p]:
                j += 1
            if j > i and j + p - i >= max(6, 4 * p):
                out.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((s, e - s, p) for (s, e), p in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_runs_of_random_sequences():
    rng = random.Random(8)
    for _ in range(300):
        seq, begin, want = [], [0], []
        for d in range(rng.randrange(1, 5)):
            x, k = [], rng.choice([1, 2, 3, 40])
            for _ in range(rng.randrange(6)):
                kind, piece = rng.random(), [rng.randrange(k) for _ in range(rng.randrange(1, 70))]
                x += piece if kind < 0.3 else (piece * 9)[: rng.randrange(1, 8 * len(piece) + 1)] if kind < 0.8 else (piece[:3] * rng.randrange(1, 20) + [99]) * rng.randrange(1, 7)
            want += [(s + begin[-1], n, p) for s, n, p in brute_runs(x[:900])]
            seq += x[:900] + [10**6 + d]
            begin.append(len(seq))
        got = runs.runs_of(np.array(seq), np.array(begin))
        assert [(s, e - s, p) for s, e, p in got.tolist()] == want


def test_runs_of_texts(spark, odd_rows):
    rng = random.Random(4)
    rows = [r for r in odd_rows if r[0] != 99]
    rows += [(200 + i, "x " * rng.randrange(9) + " é  b\n" * rng.randrange(20) + "y" * rng.randrange(2)) for i in range(20)] + [(300, "Ab ab " * 30)]
    got = runs.find_runs(frame(spark, rows), keep=("doc_id", "runs", "start"))
    assert got.columns == ["doc_id", "runs", "start", "runs", "collapsed", "n_words"]
    got = runs.find_runs(frame(spark, rows)).collect()
    want = collections.Counter((i, tuple(brute_runs(split(t))), collapsed(split(t), brute_runs(split(t))), len(split(t))) for i, t in rows)
    assert collections.Counter((r["doc_id"], tuple(map(tuple, r["runs"])), r["collapsed"], r["n_words"]) for r in got) == want
    assert runs.find_runs(frame(spark, [])).count() == 0
    long = runs.find_runs(frame(spark, [(1, "ab " * 300_000), (2, " ".join(str(i % 70_001) for i in range(300_000)))])).collect()
    assert sorted((r["doc_id"], tuple(map(tuple, r["runs"]))) for r in long) == [(1, ((0, 300_000, 1),)), (2, ((0, 300_000, 70_001),))]


def test_runs_query(spark, sf):
    """The planted repetitions of the query, from its own formula, and all digests."""
    want = {}
    for r in table(spark, sf, "documents").collect():
        words, h = split(r["text"]), zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 3000:
            continue  # brute force is quadratic
        found = brute_runs(words)
        best = min(found, key=lambda f: (-f[1], f[0], f[2]), default=None)
        lines = "".join(f"{s},{m},{p}\n" for s, m, p in found)
        want[r["doc_id"]] = (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                             hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, found).encode()).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in runs.op12(spark, sf).collect()}
    assert len(want) > 150 and all(got[i] == w for i, w in want.items())
    assert sum(w[0] > 0 for w in want.values()) >= 10


# -- manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        out.append(nodes)
    return out


def siblings(tree, at):
    out = []
    for nodes in tree[:-1]:
        first = at // 16 * 16
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 16])))
        at //= 16
    return out


def brute_manifest(rows):
    """(source, doc_id, leaf) rows to (…, subroot, root, path)."""
    groups = collections.defaultdict(list)
    for s, d, x in rows:
        groups[s].append((d is not None, d or 0, x))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x for *_, x in sorted(groups[s])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for i, s in enumerate(names):
        for j, (known, d, x) in enumerate(sorted(groups[s])):
            path = siblings(trees[s], j) + siblings(top, i)
            at = x
            for a, b in path:
                at = h(a, at, b)
            assert at == top[-1][0]
            out.append((s, d if known else None, x, trees[s][-1][0], top[-1][0], tuple(path)))
    return collections.Counter(out)


@pytest.mark.parametrize("block", [None, 2])
def test_manifest(spark, block, monkeypatch):
    if block:  # blocks of 256 leaves: a source takes several tiers
        monkeypatch.setattr(merkle, "DIGITS", block)
        monkeypatch.setattr(merkle, "BLOCK", 16**block)
    rows = [(None, 5, h("x")), (None, None, h("y")), ("", 1, h("z")), ("é", 1, h("a")), ("Z", 1, h("b")), ("a", 1, h("c"))]
    rows += [("hot", i % 700 if i % 3 else None, h(str(i % 900))) for i in range(1500)] + [("same", 4, h("same"))] * 600
    rows += [(f"s{i}", j, h(f"{i}-{j}")) for i in range(20) for j in range(i)] + [("257", i, h(str(i))) for i in range(257)] + [("16", i, h(str(i))) for i in range(16)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame([(*r, {"a": 1}, "x", 1) for r in rows], "source string, doc_id bigint, leaf string, m map<string,int>, path string, n int")
    got = merkle.manifest(df)
    assert got.columns == ["source", "doc_id", "leaf", "m", "n", "subroot", "root", "path"]
    found = collections.Counter((r["source"], r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(map(tuple, r["path"]))) for r in got.collect())
    assert found == brute_manifest(rows)
    assert merkle.manifest(df.limit(0)).count() == 0 and merkle.manifest(df.limit(0)).columns == got.columns


def test_manifest_of_one_leaf(spark):
    got = merkle.manifest(spark.createDataFrame([("s", 1, h("q"))], "source string, doc_id bigint, leaf string")).collect()
    assert [tuple(r) for r in got] == [("s", 1, h("q"), h("q"), h("q"), [])]


def test_leaves_and_tampering(spark):
    rows = [(1, "Ab", None, "en", 2), (None, None, "s", None, None), (3, "", "é", "", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")
    got = df.select(merkle.document_leaves(df).alias("x")).collect()
    assert [r["x"] for r in got] == [h(framed(d), framed(s), framed(lang), framed(n), framed(t)) for d, t, s, lang, n in rows]


def test_manifest_query_finds_tampered_rows(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    for r in merkle.op13(spark, sf).collect():
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and re.search("[A-Z]", texts[r["doc_id"]] or "")
        assert r["verified"] == (not changed)


def test_pieces_are_encoded_as_whole_texts():
    """Cuts, memory generations and rows of pieces change no id."""
    with open(TOKENIZER, encoding="utf-8") as f:
        tool, whole = packed.Encoder(f.read()), Tokenizer.from_file(TOKENIZER)
    parts = ["\n", "don", "t", "re", ".", ",", "\r\n", "a", "B", "1", "'", "'s", " ", " ", "  ", "\t", "\xa0", "　", "é", "漢", "\x1c", "\x85", "-", "<|end", "🙂", "​", "᠎", " "]
    rng = random.Random(1)
    for _ in range(10):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(2000)]
        want = [x.ids + [0] for x in whole.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x.as_py(), "<u4").tolist() for x in tool.encode(packed.pa.array(texts), 0)] == want
        tool.known, tool.older = {}, tool.known
