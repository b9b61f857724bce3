"""Secrets in layers, the Merkle manifest and token alignment, against brute force and on awkward rows."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from maskline.llm import alignment, merkle, queries, secrets

DATA = "/root/testdata/sf0.001"
SECRET = "api_key = 'abcdEFGH12345678'"
AWKWARD = [(1, None), (2, ""), (3, " \n"), (3, "the same"), (3, "the same"), (None, "no id"), (4, "a b\r\nc\td  e\x1c\x85 f\n\n\ng"), (5, "▁ reads as a blank"), (6, "<s> <|endoftext|> don't 日本 éà ²."), (7, "word, " * 300_000), (8, "x" * 5000), (9, SECRET * 3)]


def plain_spans(text):
    """The kinds as the contract words them."""
    out = []
    for k, (kind, pattern, flags, group, least) in enumerate(
        [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 0, 18), ("hex", "[0-9a-f]+", 0, 0, 16)]
    ):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


def frame(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns)


def test_base_spans_are_those_of_the_contract(spark):
    rnd = random.Random(5)
    parts = ["password", "PassWD", "toKen", "api_key", "APIKEY", "ſecret", "K", ":", "=", " ", '"', "'", "abc", "deadbeef", "0123456789", "AKIA", "ABCDEF", "é", "\n", ".", "-", "secret"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    got = secrets.with_secrets(frame(spark, list(enumerate(texts)))).collect()
    for r in got:
        assert [tuple(s) for s in r["base"]] == plain_spans(texts[r["doc_id"]])
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}
    assert sum(len(r["base"]) for r in got) > 500


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress, lambda b: gzip.compress(bz2.compress(b)), lambda b: b])
def test_packed_layers_map_to_their_blob(pack):
    blob = base64.b64encode(pack(("é " + SECRET).encode())).decode()
    for wrapped, whole in ((blob, pack(b"x") != b"x"), (urllib.parse.quote(blob, safe=""), pack(b"x") != b"x")):
        text = f"é before {wrapped} after"
        spans = secrets.all_spans(text, secrets.base_spans(text))
        assign = [(s, e) for s, k, e in spans if k == 0]
        assert len(assign) == 1
        inside = text.index(wrapped)
        if whole:
            assert text[slice(*assign[0])].rstrip("=%3D") == wrapped.rstrip("=%3D")
        else:
            assert inside < assign[0][0] < assign[0][1] <= inside + len(wrapped)


def test_escapes_map_to_their_characters():
    for escape in (lambda c: f"%{ord(c):02X}", lambda c: f"\\u{ord(c):04x}", lambda c: f"\\x{ord(c):02x}", lambda c: f"\\U{ord(c):08x}", lambda c: f"\\u{{{ord(c):x}}}", lambda c: f"%25{ord(c):02X}", lambda c: "%5Cu" + f"{ord(c):04x}"):
        text = "é " + "".join(map(escape, SECRET)) + " z"
        spans = secrets.all_spans(text, secrets.base_spans(text))
        assert [text[s:e] for s, k, e in spans if k == 0] == ["".join(map(escape, SECRET[:-1]))]  # the closing quote is not part
    plain = "%zz %41 \\ud800 \\q secret: short"
    assert secrets.all_spans(plain, []) == []
    mixed = "token = abc%2Fdef%2Fghijk"  # too short as it stands, long enough below
    assert secrets.base_spans(mixed) == [] and secrets.all_spans(mixed, []) == [(0, 0, len(mixed))]


def test_base64_over_lines_and_endless_layers():
    text = "x\n" + base64.encodebytes((SECRET + " and more words to fill a second line of digits").encode()).decode()
    assert [k for _, k, _ in secrets.all_spans(text, secrets.base_spans(text))] == [0]
    rows = base64.b64encode(("first line\n" + SECRET + "\nlast " + SECRET).encode()).decode()
    assert len(secrets.all_spans(rows, [])) == 2
    loop = base64.b64encode(b"\x1f\x8b" + b"not really packed").decode()
    assert secrets.all_spans(loop, []) == []
    deep = SECRET
    for _ in range(12):
        deep = base64.b64encode(deep.encode()).decode()
    assert len(secrets.all_spans(deep, [])) == 1
    cut = base64.b64encode(gzip.compress(("\n".join(f"{i} line" for i in range(9000)) + SECRET + "\n" + "z\n" * 90000).encode())[:-40]).decode()  # damaged at the end
    assert [k for _, k, _ in secrets.all_spans(cut, [])] == [0]
    big = base64.b64encode(gzip.compress(b"a line\n" * 3_000_000 + SECRET.encode())).decode()
    assert [(s, e) for s, k, e in secrets.all_spans(big, []) if k == 0] == [(0, len(big))]


def test_unpacking_that_gives_itself_ends():
    layer, seen = [b"\x1f\x8bsame"], []

    class Same:
        eof, needs_input = True, True

        def decompress(self, data, most):
            seen.append(data)
            return data

    held = secrets.MAGICS[0]
    secrets.MAGICS[0] = (b"\x1f\x8b", Same)
    try:
        packed, pieces = secrets._opened(layer[0])
        assert packed and list(secrets._texts(pieces)) == [] and len(seen) <= 2
    finally:
        secrets.MAGICS[0] = held


def test_secrets_on_awkward_rows(spark):
    df = frame(spark, [(i, t, "x", 1) for i, t in AWKWARD], "doc_id long, text string, base string, Spans int")
    got = secrets.with_secrets(df).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        assert [tuple(s) for s in r["base"]] == plain_spans(r["text"] or "")
    assert secrets.with_secrets(df.limit(0)).count() == 0
    query = queries.op11_secret_layers(spark, DATA)
    assert query.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    texts = {r["doc_id"]: r["text"] or "" for r in queries.table(spark, DATA, "documents").collect()}
    for r in query.collect():
        base = plain_spans(texts[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(b[0] == k for b in base) for k in secrets.KINDS]
        listed = [":".join(map(str, b)) for b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r["spans"].split(",")) | {""}


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """Per row: leaf, subroot, root, proof, folded root, in a list by (source, id, leaf)."""
    put = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for r in rows:
        leaf = h(*map(put, r))
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
        groups[r[1]].append(((r[0] is not None, r[0] or 0, leaf), r, leaf, h(*map(put, (*r[:4], r[4].replace("\n", "")))) if tampered else leaf))

    def tree(nodes):
        """Root, and for each node its list of (before, after)."""
        paths, at, owners = [[] for _ in nodes], list(nodes), [[i] for i in range(len(nodes))]
        while len(at) > 1:
            up, above = [], []
            for i in range(0, len(at), 3):
                run = at[i : i + 3]
                for j in range(len(run)):
                    for o in owners[i + j]:
                        paths[o].append(("".join(run[:j]), "".join(run[j + 1 :])))
                up.append(h(*run))
                above.append([o for own in owners[i : i + 3] for o in own])
            at, owners = up, above
        return at[0], paths

    if not groups:
        return []
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = [(sorted(groups[s], key=lambda x: x[0]),) for s in order]
    built = [(g, *tree([x[2] for x in g])) for (g,) in built]
    root, over = tree([b[1] for b in built])
    out = []
    for (g, sub, paths), up in zip(built, over, strict=True):
        for (_, r, leaf, fold), path in zip(g, paths, strict=True):
            for before, after in path + up:
                fold = h(before, fold, after)
            out.append((r[0], leaf, sub, root, h("".join(b + a for b, a in path + up)), fold, fold == root))
    return out


@pytest.mark.parametrize("counts", [[0], [1], [2], [1, 1], [40, 1, 3, 4], [300, 27, 28, 1, 1, 1, 2, 9, 81]])
def test_manifest_against_brute_force(spark, counts, monkeypatch):
    monkeypatch.setattr(merkle, "HEAVY_LEAVES", 10)
    monkeypatch.setattr(merkle, "HEAVY", 20)
    rnd = random.Random(sum(counts))
    sources = [None, "", "a", "B", "é", "z\U0001f600", "￿", "b", "aa"]
    rows = [(i * 1000 + j * 7 % 911, sources[i], rnd.choice([None, "en"]), rnd.choice([None, j]), rnd.choice([None, "", "a\nb", f"t{j}", "\n"])) for i, n in enumerate(counts) for j in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumn("leaf", F.lit(1)).withColumn("part", F.lit("p"))
    got = merkle.manifest(df, range_bytes=2000)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_manifest(rows))


def test_manifest_on_awkward_rows(spark):
    rows = [(i, None if i == 3 else "s", "en", None, t) for i, t in AWKWARD]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got, want = merkle.manifest(df).collect(), plain_manifest(rows)
    once = lambda rs: sorted((str(r[0]), *r[1:4]) for r in rs)  # noqa: E731  equal ids: order among them is by a hash of the leaf
    assert len(got) == len(rows)
    assert sorted((str(r[0]), r[1]) for r in got) == sorted((str(r[0]), r[1]) for r in want)
    assert len({r["root"] for r in got}) == 1 and len({r["subroot"] for r in got}) == 2
    alone = [r for r in rows if r[0] not in (3, None)]
    df = spark.createDataFrame(alone, df.schema)
    assert once(merkle.manifest(df).collect()) == once(plain_manifest(alone))


def plain_alignment(rows):
    """The contract, by the libraries on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_file("piece_bpe_32k.model"))
    letters = alignment.byte_letters()
    docs, count = [], Counter()
    for i, text in rows:
        links, groups = [], []
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        xb = [bytes(letters[c] for c in a.id_to_token(t)) for t in x]
        yb = [bytes([int(p[3:5], 16)]) if b.is_byte(t) else p.replace("▁", " ").encode() for t in y for p in [b.id_to_piece(t)]]
        if b"".join(xb) == b"".join(yb) == (" " + (text or "")).encode() and text:
            spans = lambda parts: [(sum(map(len, parts[:k])), sum(map(len, parts[: k + 1]))) for k in range(len(parts))]
            xs, ys = spans(xb), spans(yb)
            ends = sorted({e for _, e in xs} & {e for _, e in ys})
            for s, e in zip([0, *ends], ends, strict=False):
                own = [[t for t, (p, q) in zip(ids, at, strict=True) if s <= p and q <= e] for ids, at in ((x, xs), (y, ys))]
                groups.append("|".join(",".join(map(str, g)) for g in own))
            links = [(t, u) for t, (p, q) in zip(x, xs, strict=True) for u, (r, s) in zip(y, ys, strict=True) if p < s and r < q]
        else:
            x = y = []
        docs.append((i, len(x), len(y), groups, links))
        count.update(set(links))
    best = defaultdict(int)
    for (t, _), n in count.items():
        best[t] = max(best[t], n)
    return [(i, na, nb, len(g), len(k), sum(count[p] == best[p[0]] for p in k), sum(count[p] for p in k), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, na, nb, g, k in docs]


def test_alignment_against_brute_force(spark, monkeypatch):
    rnd = random.Random(3)
    parts = ["a", "word ", "wording ", " ", "\n", "\r", "\t", "  ", "\x1c", "\x85", "\xa0", "é", ".", ",", "▁", "<s>", "<|endoftext|>", "'s", "12", "日本", "'", "²", ";\r", "aaaa", "    "]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 25)))) for i in range(400)]
    rows += [(i, None if t is None else t[:40]) for i, t in AWKWARD]
    rows += [(1000 + r["doc_id"], r["text"] and r["text"][:600]) for r in queries.table(spark, DATA, "documents").limit(40).collect()]
    monkeypatch.setattr(alignment, "PART", 64)  # texts of several parts
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("where", F.lit(7)).withColumn("code", F.lit("c")).repartition(3)
    paths = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
    for size in (1000, 8 << 20):
        got = alignment.align(df, *paths, range_bytes=size)
        key = lambda r: tuple(map(str, r))
        assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_alignment(rows), key=key)
    pair = alignment.aligner(*paths)
    monkeypatch.setattr(alignment, "PART", 64)
    texts = [t for _, t in rows]
    whole = pair.linked(texts)
    monkeypatch.setattr(alignment, "KEPT", 0)  # chunks forgotten at every part
    assert whole.tolist() == pair.linked(texts).tolist()


def test_alignment_on_awkward_rows(spark):
    paths = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
    df = frame(spark, AWKWARD)
    got = {(r["doc_id"], r["n_a"]): r for r in alignment.align(df, *paths).collect()}
    assert len(alignment.align(df, *paths).collect()) == len(AWKWARD) and alignment.align(df.limit(0), *paths).count() == 0
    assert got[1, 0]["groups_sha256"] == got[2, 0]["groups_sha256"] == got[5, 0]["groups_sha256"] == ""
    long = next(r for r in got.values() if r["doc_id"] == 7)
    assert long["n_a"] == 600_001 and long["n_links"] >= 600_000


def test_alignment_reads_texts_once(spark):
    """One pass of the tokenizers describes the texts; before, the rating read and encoded them again."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    paths = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
    df = spark.createDataFrame([(i, f"some words of text {i}") for i in range(100)], "doc_id long, text string")
    want = sorted(map(tuple, alignment.align(df, *paths).collect()))
    assert sorted(map(tuple, alignment.align(df.mapInArrow(counted, df.schema), *paths).collect())) == want
    assert read.value == 200, read.value  # once for the ranges, once by the tokenizers; 300 before
