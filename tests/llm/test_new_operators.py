"""Archives, alignment of tokenizers and spelling variants: odd tables, and brute force on small ones."""

import collections
import functools
import glob
import gzip
import hashlib
import io
import itertools
import random
import re
import zlib
from base64 import b32encode

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from parasynth.llm import alignment, variants, warc

PAGES = "page_id long, url string, html string, sha string, shard int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 9) for i, u, h in rows], PAGES)


def some_pages(n=400, seed=5):
    rnd = random.Random(seed)
    body = lambda: "".join(rnd.choice("abc <>é🙂\n") for _ in range(rnd.randint(0, 900)))
    few = [body() for _ in range(12)]
    rows = [(i, f"http://h{i % 7}.example/{i}", few[0] if i % 3 == 0 else rnd.choice(few) if i % 2 else body()) for i in range(n)]
    odd = [(n, None, None), (n + 1, "http://a\r\nX-Page-ID: 7", ""), (None, "u", "alone"), (None, "v", few[1]), (None, "w", "pair"), (None, "w", "pair")]
    return [*rows, *odd, rows[3], rows[3], (n + 2, "long", "x y" * 200_000)]


def brute_records(rows, least=0):
    keeper = {}
    for i, _, h in rows:
        if i is not None:
            keeper[h or ""] = max(i, keeper.get(h or "", i))
    out = []
    for i, _, h in rows:
        data, k = (h or "").encode(), keeper.get(h or "")
        stored = k is None or i == k or len(data) < least
        out.append((i, len(data), b32encode(hashlib.sha1(data).digest()).decode(), "response" if stored else "revisit", None if stored else k))
    return sorted(out, key=str)


def records_of(spark, folder):
    return sorted(map(tuple, warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def files_of(folder):
    return {f.rsplit("/", 1)[1]: open(f, "rb").read() for f in glob.glob(f"{folder}/*.warc.gz")}


@pytest.mark.parametrize("least", [0, 300])
def test_warc_round_trip(spark, tmp_path, least):
    rows = some_pages()
    folder = f"file://{tmp_path}/a"
    made = warc.write(pages_of(spark, rows), folder, least=least, roll=6_000, shard=60_000).collect()
    assert records_of(spark, folder) == brute_records(rows, least)
    files = files_of(f"{tmp_path}/a")
    assert {m.name: (m.bytes, m.sha1) for m in made} == {k: (len(v), hashlib.sha1(v).hexdigest()) for k, v in files.items()}
    assert len({m.shard for m in made}) > 3 and max(m.seq for m in made) > 0  # shards and rolled files
    assert all(m.bytes <= 6_000 or m.records == 2 for m in made)
    payloads = {r.page_id: bytes(r.payload) for r in warc.read(spark, folder, payload=True).where("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert all(payloads[i] == (h or "").encode() for i, _, h in rows if i in payloads)
    assert not glob.glob(f"{tmp_path}/a/_temporary*")


def test_warc_is_deterministic(spark, tmp_path):
    rows = some_pages(200)
    warc.write(pages_of(spark, rows).repartition(5), f"{tmp_path}/a", shard=40_000)
    random.Random(1).shuffle(rows)
    warc.write(pages_of(spark, rows).repartition(3, "url"), f"{tmp_path}/b", shard=40_000)
    assert files_of(f"{tmp_path}/a") == files_of(f"{tmp_path}/b")


def test_warc_standard(spark, tmp_path):
    """Members can be read one by one; headers follow the standard; identifiers are unique and those referred to exist."""
    rows = some_pages(150)
    warc.write(pages_of(spark, rows), f"{tmp_path}/a", shard=40_000)
    ids, refers, number = [], set(), 0
    for name, data in sorted(files_of(f"{tmp_path}/a").items()):
        heads = list(warc.records(io.BytesIO(gzip.decompress(data))))
        assert heads[0][0]["warc-type"] == "warcinfo" and heads[0][0]["warc-filename"] == name
        for head, _ in heads:
            ids.append(head["warc-record-id"])
            refers |= {head["warc-refers-to"]} if head["warc-type"] == "revisit" else set()
            assert {"warc-date", "content-type", "content-length"} <= set(head)
        number += len(heads) - 1
    assert number == len(rows) and len(ids) == len(set(ids)) and refers <= set(ids)


def test_warc_commit(spark, tmp_path):
    rows = some_pages(60)
    warc.write(pages_of(spark, rows), f"{tmp_path}/a")
    with pytest.raises(FileExistsError):
        warc.write(pages_of(spark, rows), f"{tmp_path}/a")
    (tmp_path / "a" / "pages-000099-00000.warc.gz").write_bytes(b"left by a lost attempt")
    assert records_of(spark, f"{tmp_path}/a") == brute_records(rows)
    name = warc.manifest(spark, f"{tmp_path}/a").first().name
    data = bytearray(gzip.decompress((tmp_path / "a" / name).read_bytes()))
    data[-10] ^= 1  # in the last payload
    (tmp_path / "a" / name).write_bytes(gzip.compress(bytes(data)))
    with pytest.raises(Exception, match="digest"):
        records_of(spark, f"{tmp_path}/a")


def test_warc_empty(spark, tmp_path):
    assert warc.write(pages_of(spark, []), f"{tmp_path}/a").count() == 0 and records_of(spark, f"{tmp_path}/a") == []


# --- alignment of tokenizers -------------------------------------------------------------

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@functools.cache
def both_tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return a, sentencepiece.SentencePieceProcessor(model_file=B), byte


def brute_groups(text):
    """Groups of (A ids, B ids): whole texts encoded, cut where ends coincide."""
    if not text:
        return []
    a, b, byte = both_tokenizers()
    left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    want = (" " + text).encode()
    if b"".join(x for _, x in left) != want or b"".join(x for _, x in right) != want:
        return []
    ends = [set(itertools.accumulate(len(x) for _, x in side)) for side in (left, right)]
    cuts, out = sorted(ends[0] & ends[1]), []
    for side in (left, right):
        at, k, groups = 0, 0, [[] for _ in cuts]
        for i, x in side:
            at += len(x)
            groups[k].append(i)
            k += at == cuts[k]
        out.append(groups)
    return list(zip(*out))


def brute_alignment(rows):
    links, groups = [], [brute_groups(t) for _, t in rows]
    for own in groups:
        links.append(collections.Counter(p for x, y in own for p in itertools.product(x, y)))
    count = collections.Counter(p for own in links for p in own)
    most = collections.defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (i, _), own, link in zip(rows, groups, links):
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in own)
        sha = hashlib.sha256(said.encode()).hexdigest() if own else ""
        best, total = sum(n for p, n in link.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in link.items())
        out.append((i, sum(len(x) for x, _ in own), sum(len(y) for _, y in own), len(own), sum(link.values()), best, total, sha))
    return sorted(out, key=str)


def odd_texts():
    rnd = random.Random(8)
    alphabet = ["a", "b", "The", "ing", " ", "  ", "\n", "\t", "é", "🙂", "日本", "'s", "1", "23", "▁", "\x1c", "᠎", "​", "﻿", " ", "<|endoftext|>", "<s>", "<0x41>", "\x00", "ﬁ", "́", ".", "--", "\r"]
    few = [x for x in alphabet if x != "▁"]
    made = ["".join(rnd.choice(few) for _ in range(rnd.randint(1, 60))) for _ in range(400)]
    made += [" ".join(rnd.choice(few) for _ in range(rnd.randint(1, 60))) for _ in range(200)]
    made += [None, "", " ", "   ", "\n", "x", " x ", "a ▁ b", "日本語テスト" * 300, "é" * 5_000, "=" * 3_000 + "-" * 3_000, "a" * 20_000, "say <|endoftext|> and </s>"]
    made += ["the same text", "the same text"]
    return [(None if i % 97 == 5 else i, t) for i, t in enumerate(made)]


@pytest.mark.parametrize("plain,block", [(4_096, 8 << 20), (3, 2_000)])
def test_alignment(spark, monkeypatch, plain, block):
    rows = odd_texts()
    docs = spark.createDataFrame([(i, t, 1, "k", 3) for i, t in rows], "doc_id long, text string, block int, code string, n long").repartition(3)
    if plain == 4_096:
        assert sorted(map(tuple, alignment.align(docs, A, B).collect()), key=str) == brute_alignment(rows)
        pairs = {(r.a, r.b): (r.n, r.best) for r in alignment.token_pairs(docs, A, B).collect()}
        count = collections.Counter(p for _, t in rows for p in {p for x, y in brute_groups(t) for p in itertools.product(x, y)})
        assert {p: n for p, (n, _) in pairs.items()} == count
    else:  # distinct tokens of large groups, caches that are cleared
        monkeypatch.setattr(alignment, "PLAIN", plain)
        monkeypatch.setattr(alignment, "CACHE", 50)
        own = alignment.Aligner(A, B)
        for at in range(0, len(rows), 7):
            part = [t for _, t in rows[at : at + 7]]
            made = own.block(part)
            for k, t in enumerate(part):
                link = collections.Counter(p for x, y in brute_groups(t) for p in itertools.product(x, y))
                i, j = made["first"][k], made["first"][k + 1]
                codes = made["codes"][made["pair"][i:j]]
                assert {(int(c) >> 32, int(c) & 0xFFFFFFFF): int(n) for c, n in zip(codes, made["times"][i:j])} == link


def test_alignment_odd(spark, odd, none):
    made = alignment.align(odd, A, B).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, made), key=str) == brute_alignment(rows)
    assert alignment.align(none, A, B).count() == 0 and alignment.token_pairs(none, A, B).count() == 0


# --- spelling variants -------------------------------------------------------------------


def brute_variants(rows, one_in=97, least=3):
    count = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            count[run] += 1
    known = {w: n for w, n in count.items() if len(w) >= 5 and n >= least}

    def near(u, v):
        if u == v or abs(len(u) - len(v)) > 1:
            return False
        if len(u) > len(v):
            u, v = v, u
        k = next((k for k in range(len(u)) if u[k] != v[k]), len(u))
        return u[k + 1 :] == v[k + 1 :] if len(u) == len(v) else u[k:] == v[k + 1 :]

    form, out = {}, {}
    for w, n in known.items():
        own = [v for v in known if near(w, v)]
        best = min(own, key=lambda v: (-known[v], v), default=None)
        form[w] = best if best and known[best] >= 2 * n else None
        out[w] = n, len(own)
    rows = []
    for w, (n, n_near) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, n_near, known.get(form[w])))
    return sorted(rows, key=str)


def variant_texts(seed, letters="abé×C"):
    rnd = random.Random(seed)
    stems = ["".join(rnd.choice(letters) for _ in range(rnd.randint(4, 8))) for _ in range(60)]
    long = "".join(rnd.choice("xy") for _ in range(18))
    stems += [long, long[:14] + long[15:], long[:12] + "z" + long[12:], long + "x", "q" * 12, "q" * 13, "q" * 14]
    return [(i, " ".join(rnd.choice(stems) if rnd.random() < 0.7 else stems[0][: rnd.randint(3, 8)] + rnd.choice(letters) for _ in range(90))) for i in range(40)] + [(None, "Qqqqqq qqqqqq qqqqqq qqqqqqq"), (41, None), (42, ""), (42, "1,2;3")]


@pytest.mark.parametrize("seed,one_in,plain", [(2_000, 97, 48), (5, 2, 6)])
def test_variants(spark, monkeypatch, seed, one_in, plain):
    monkeypatch.setattr(variants, "PLAIN", plain)  # longer prefixes are named by a digest
    rows = variant_texts(seed)
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n int, word string").repartition(4)
    got = variants.group_variants(docs, one_in=one_in)
    want = brute_variants(rows, one_in)
    assert sorted(map(tuple, got.collect()), key=str) == want and got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert any(len(r[0]) > 12 and r[4] for r in want) and (one_in > 2 or any(r[1] != r[2] for r in want if r[1]))  # long words, forms of forms


def test_variants_odd(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, variants.group_variants(odd).collect()), key=str) == brute_variants(rows)
    assert variants.group_variants(none).count() == 0
