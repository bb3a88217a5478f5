"""Every operator on odd tables, and against brute force on small ones."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from parasynth.llm import backtrack_bpe, bin_slack, components, kneser_ney, license_templates, licenses, line_templates, order_minhash, quality_rules, repeats, secrets, simhash
from parasynth.llm.queries import TOKENIZER

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("a", "er", "on", "is", "um")]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# --- connected components, SimHash -----------------------------------------------------


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(rnd.randint(200, 400), rnd.randint(200, 400)) for _ in range(120)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute_components(prints, most):
    ids = sorted(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if label[b] < label[a] and bin(prints[a] ^ prints[b]).count("1") <= most:
                    label[a], changed = label[b], True
    return label


def test_fingerprints_and_links(spark):
    rnd = random.Random(2)
    rows = []
    for g in range(12):
        words = prose(rnd, 200).split()
        for k in range(5):
            changed = list(words)
            for _ in range(k * 2):
                changed[rnd.randrange(200)] = rnd.choice(WORDS)
            rows.append((g * 10 + k, " ".join(changed)))
    rows += [(900, ""), (901, "A b"), (902, "a  B"), (903, None)]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(spark, rows), 4, 6).collect()}
    import xxhash

    prints = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        hs = [xxhash.xxh64_intdigest(" ".join(w[j : j + 4]), 42) for j in range(max(1, len(w) - 3))] if w else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    assert {i: f"{p:016x}" for i, p in prints.items()} == {i: r.fingerprint for i, r in got.items()}
    assert {i: r.component_id for i, r in got.items()} == brute_components(prints, 6)


def test_many_fingerprints_of_one_key(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 40)
    rnd = random.Random(3)
    base = rnd.getrandbits(64)
    values = list({base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for _ in range(300)})
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    edges = simhash.links(frame, 4)
    found = {r.node: r.component for r in components.components(edges, "a", "b").collect()}
    signed = {int(np.uint64(v).astype(np.int64)): v for v in values}
    assert brute_components(signed, 4) == {i: found.get(i, i) for i in signed}


def test_simhash_odd(odd, none):
    got = simhash.near_duplicates(odd).collect()
    by = collections.defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.fingerprint, r.component_id))
    assert len(got) == 9 and by[1] == by[2] == by[6] == {("0" * 16, 1)} and by[4] == by[5] and {c for _, c in by[4]} == {4}
    assert [c for _, c in by[None]] == [None]
    assert simhash.near_duplicates(none).count() == 0


def test_drop_near_duplicates(spark, odd, none):
    """One row of each component of near_duplicates stays, the first; links may chain."""
    rnd = random.Random(4)
    rows = []
    for g in range(30):
        words = prose(rnd, 200).split()
        rows += [(100 * g + k, " ".join(words + ["end"] * k)) for k in (5, 3, 0, 1)]
    rows += [(2, rows[0][1]), (2, rows[0][1]), (-7, "alone here"), (-7, "alone here"), (9_999, rows[7][1])]
    docs = docs_of(spark, rows).repartition(3)
    labels = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = [r.doc_id for r in simhash.drop_near_duplicates(docs).collect()]
    assert sorted(kept) == sorted(set(labels.values())) and len(kept) < 60 and -7 in kept and 9_999 not in kept
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "7", "None"]
    assert simhash.drop_near_duplicates(none).count() == 0


# --- licences ---------------------------------------------------------------------------


def brute_license(text):
    best = []
    for unit in {*text.split("\n"), *re.split(r"\n[ \t]*\n", text), text}:
        found = set(licenses.bigrams(unit))
        scores = [(2 * len(found & set(licenses.bigrams(w))) / (len(found) + len(licenses.bigrams(w))), n) for n, w in license_templates.TEMPLATES]
        if max(scores)[0] >= licenses.LEAST:
            best.append(max(scores))
    return (max(best)[1], round(max(best)[0], 6), ",".join(sorted({n for _, n in best}))) if best else (None, None, "")


def test_licenses(spark, odd, none):
    rnd = random.Random(5)
    rows = []
    for i in range(40):
        name, wording = rnd.choice(license_templates.TEMPLATES)
        words = wording.split(" ")
        for _ in range(rnd.randint(0, max(1, len(words) // 8))):
            words[rnd.randrange(len(words))] = rnd.choice(WORDS)
        rows.append((i, rnd.choice(["", prose(rnd, 20) + "\n", prose(rnd, 5) + "\n\n"]) + " ".join(words) + rnd.choice(["", "\n" + prose(rnd, 9), "\n \n" + prose(rnd, 400)])))
    got = {r.doc_id: (r.license, r.dice, r.licenses) for r in licenses.scan_licenses(docs_of(spark, rows)).collect()}
    assert got == {i: brute_license(t) for i, t in rows}
    assert {(r.license, r.n_units) for r in licenses.scan_licenses(odd).collect()} == {(None, 0)}
    assert licenses.scan_licenses(none).count() == 0


# --- order MinHash ------------------------------------------------------------------------


def test_order_minhash(spark, odd, none):
    rnd = random.Random(6)
    rows = [(i * 3, prose(rnd, rnd.randint(0, 120))) for i in range(60)] + [(500, None), (501, "")]
    for per in (5, 1000):
        got = sorted(order_minhash.compare_with_next(docs_of(spark, rows), per).collect(), key=lambda r: r.doc_id)
        ordered = [(i, t or "") for i, t in sorted(rows)]
        for r, (i, t), (_, after) in zip(got, ordered, ordered[1:] + ordered[:1], strict=True):
            n = len(t) // 4
            new = t[: len(t) - n] + after[:n] if n else t
            assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(t), hashlib.sha256(new.encode()).hexdigest())
            own = order_minhash.signature(t)
            assert r.near_next == order_minhash.likeness(own, order_minhash.signature(after)) and r.near_edited == order_minhash.likeness(own, order_minhash.signature(new))
    assert order_minhash.compare_with_next(odd).count() == 9 and order_minhash.compare_with_next(none).count() == 0
    lone = order_minhash.compare_with_next(docs_of(spark, [(1, "abcdefgh")])).collect()
    assert len(lone) == 1 and lone[0].near_next == 1.0


def test_likeness_follows_order_and_edits():
    rnd = random.Random(7)
    words = prose(rnd, 400).split()
    text = " ".join(words)
    sign = order_minhash.signature
    moved = " ".join(words[200:] + words[:200])
    slight = " ".join(words[:390] + ["zz"] * 10)
    assert order_minhash.likeness(sign(text), sign(slight)) > 0.85
    assert order_minhash.likeness(sign(text), sign(moved)) < 0.75  # the same k-mers, half of the pairs turned round
    assert order_minhash.likeness(sign("ab" * 50), sign("ab" * 25)) < 0.9  # occurrences count
    assert (sign(text) == sign(text)).all()


# --- quality rules ------------------------------------------------------------------------


def test_quality_counts(spark, odd, labels, none):
    rnd = random.Random(8)
    rows = [(i, "\n".join(" ".join(rnd.choice(["a", "b", "c#", "d|e"]) for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(1, 30)))) for i in range(60)]
    frame = docs_of(spark, rows).selectExpr("*", "'en' AS lang")
    got = {r.doc_id: r for r in quality_rules.features(frame).collect()}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        places = collections.defaultdict(list)
        for j in range(len(w) - 2):
            places[tuple(w[j : j + 3])].append(j)
        covered = {j + k for v in places.values() if len(v) > 1 for j in v for k in range(3)}
        lines = [x for x in t.split("\n") if x.split()]
        assert tuple(got[i][c] for c in quality_rules.BASE) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
    assert quality_rules.quality_rules(odd, labels).count() == 9
    assert quality_rules.quality_rules(none, labels).count() == 0
    assert [r.doc_id for r in quality_rules.drop_low_quality(odd, labels).collect()] == []
    good = odd.where("doc_id = 3").selectExpr("doc_id", "concat(text, ' ', 'x y z') AS text", "lang", "row")
    varied = docs_of(spark, [(1, prose(rnd, 80))]).selectExpr("*", "'en' AS lang", "'r' AS row", "1 AS words")
    assert quality_rules.drop_low_quality(varied, labels.limit(0)).columns == varied.columns and quality_rules.drop_low_quality(varied, labels.limit(0)).count() == 1
    assert quality_rules.drop_low_quality(good, labels).count() == 0  # long, but it repeats itself


def test_certified_levels(spark):
    from math import comb

    p, n, k = 0.01, 1200, 4
    exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    from pyspark.sql import functions as F

    made = spark.range(1).select(quality_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    assert made == pytest.approx(exact, rel=1e-9)
    # 2,000 good documents without symbols, 30 of another stratum with: nothing is certified there.
    rows = [(i, "a", 100, 500, 0, 0, 0, 10) for i in range(2000)] + [(5000 + i, "b", 100, 500, 60, 0, 0, 10) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")
    good = frame.selectExpr("doc_id", "1 AS quality")
    assert {r.stratum: r.level for r in quality_rules.certified_levels(frame, good).collect()} == {"a": quality_rules.LEVELS, "b": 0}


# --- repeated passages ----------------------------------------------------------------------


def brute_repeats(rows, length):
    bodies = [(i, (t or "").encode()) for i, t in rows]
    count = collections.Counter(b[k : k + length] for _, b in bodies for k in range(len(b) - length + 1))
    out = []
    for i, b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length,window,few", [(60, 30, 400_000), (40, 5, -1)])
def test_repeats(spark, monkeypatch, length, window, few):
    monkeypatch.setattr(repeats, "FEW_TEXTS", few)  # spans go to the texts, or meet them on the way
    rnd = random.Random(9)
    base = "".join(rnd.choice("abcd ") for _ in range(2000))
    rows = []
    for i in range(60):
        t = "".join(rnd.choice("abcdefgh é") for _ in range(rnd.randint(0, 200)))
        for _ in range(rnd.randint(0, 4)):
            a = rnd.randint(0, 1900)
            t += base[a : a + rnd.randint(0, 150)] + "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 30)))
        rows.append((i, t))
    rows += [(200, None), (201, ""), (202, "a" * 300), (None, rows[0][1]), (5, rows[5][1])]
    assert tuples(repeats.drop_repeats(docs_of(spark, rows), length, window).drop("text")) == brute_repeats(rows, length)


def test_repeats_leave_text(spark):
    passage = " ".join(f"word{i}" for i in range(80))
    rows = [(1, f"before {passage} after"), (2, f"{passage} other end"), (3, "untouched é text"), (4, None)]
    left = {r.doc_id: r.text for r in repeats.drop_repeats(docs_of(spark, rows)).collect()}
    assert left == {1: "before after", 2: "other end", 3: "untouched é text", 4: ""}


def test_repeats_odd(odd, none):
    got = {(r.doc_id, r.n_bytes, r.n_removed) for r in repeats.drop_repeats(odd).collect()}
    assert {(1, 0, 0), (2, 0, 0), (6, 4, 0)} <= got and repeats.drop_repeats(none).count() == 0
    data = b"x" * 300_000 + b"y" * 300_000 + bytes(random.Random(1).randrange(256) for _ in range(100_000))
    place, lo, hi = repeats.anchors(data)
    assert (lo[1:] == hi[:-1] + 1).all() and lo[0] == 0 and hi[-1] == len(data) - repeats.LENGTH and ((place >= hi) & (place < lo + repeats.WINDOW)).all()


# --- byte-level BPE -------------------------------------------------------------------------


def fuzz(rnd, n):
    parts = list("ab'stre 0.,\n\t\r  \x1c\x85\xa0　é日本🙂Ⅷ½_\x00") + ["<|endoftext|>", "  ", "'s", "aaa", "----"]
    return "".join(rnd.choice(parts) for _ in range(rnd.randint(0, n)))


def test_bpe(spark, odd, none):
    own = backtrack_bpe.codec(MULTI, public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rnd = random.Random(10)
    samples = [fuzz(rnd, 40) for _ in range(1500)] + ["a" * 3000, "ab" * 2000, " " * 999, "\n" * 500, "日" * 500]
    for t in samples:
        ids = own.encode(t)
        assert ids == theirs.encode_ordinary(t) and own.decode(ids) == t.encode()
    made = backtrack_bpe.encode(odd, MULTI, public_tokenizers.PATTERN)
    back = backtrack_bpe.decode(made, MULTI, public_tokenizers.PATTERN)
    assert sorted(bytes(r["bytes"]) for r in back.collect()) == sorted((r.text or "").encode() for r in odd.collect())
    digest = {r.doc_id: r for r in backtrack_bpe.digests(odd, MULTI, public_tokenizers.PATTERN).collect()}
    assert digest[1].n_tokens == 0 and digest[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert backtrack_bpe.digests(none, MULTI, public_tokenizers.PATTERN).count() == 0


# --- secrets ---------------------------------------------------------------------------------


def test_secrets(spark, odd, none):
    words = secrets.dictionary(RANKS)
    cost = {v: secrets.guess_cost(v, words) for v in ("password1", "qwertyuiop", "aaaaaaaaaaaa", "19851224", "abcabcabcabc", "x9$Kq!vB2zQ", "")}
    assert cost[""] == 0 and all(cost[v] < 6 for v in ("password1", "qwertyuiop", "aaaaaaaaaaaa", "19851224", "abcabcabcabc")) and cost["x9$Kq!vB2zQ"] > 10
    text = 'x PASSWORD = "hunter2" é token: zz  AKIA' + "A1" * 9 + " 0123456789abcdef01234567 pwd=x9$Kq!vB2zQ"
    spans = [(secrets.KINDS[k], text[a:b]) for a, k, b in secrets.scan(text, words)]
    assert spans == [("assign", 'PASSWORD = "hunter2'), ("access", "AKIA" + "A1" * 9), ("hex", "0123456789abcdef01234567"), ("guess", "x9$Kq!vB2zQ")]
    assert secrets.redact(text, words) == 'x [SECRET]" é token: zz  [SECRET] [SECRET] pwd=[SECRET]'
    assert {len(r.spans) for r in secrets.find_secrets(odd, RANKS).collect()} == {0} and secrets.find_secrets(none, RANKS).count() == 0
    kept = secrets.redact_secrets(odd, RANKS)
    assert tuples(kept) == tuples(odd) and kept.columns == odd.columns


# --- quality classifier -------------------------------------------------------------------------


def scorer_of(model):
    return kneser_ney.Scorer(kneser_ney._keyed(model).toArrow(), 5)


def test_kneser_ney(spark, odd, labels, none, monkeypatch):
    rnd = random.Random(11)
    rows = [(i, prose(rnd, 60), "en") for i in range(60)] + [(100 + i, "".join(rnd.choice("#$%&*xqzj ") for _ in range(300)), "en") for i in range(10)] + [(200, "other", "xx"), (201, None, "en"), (202, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    good = spark.range(60).selectExpr("id AS doc_id", "1 AS quality")
    model = kneser_ney.train(frame, good)
    shard = scorer_of(model)
    letters = [r.g for r in model.toPandas().itertuples() if r.lang == "en" and r.n == 1 and r.logp == r.logp]
    for context in ("ber", "zq", "tu ka"):
        before = shard.score("en", context)
        assert sum(np.exp(shard.score("en", context + c) - before) for c in [*letters, "☃"]) == pytest.approx(1.0)
    table = kneser_ney.train(frame, good)
    one = {r.doc_id: r.logp for r in kneser_ney.log_probabilities(frame, table, id_col="doc_id", text_col="text", lang_col="lang").collect()}
    monkeypatch.setattr(kneser_ney, "MODEL_ROWS", 0)  # by joins
    many = {r.doc_id: r.logp for r in kneser_ney.log_probabilities(frame, table, most=300, id_col="doc_id", text_col="text", lang_col="lang").collect()}
    assert one.keys() == many.keys() and all(one[i] == pytest.approx(many[i]) if one[i] is not None else many[i] is None for i in one)
    monkeypatch.undo()
    got = {r.doc_id: r for r in kneser_ney.classify(frame, good).collect()}
    assert len(got) == 73 and not any(got[100 + i].kept for i in range(10)) and sum(got[i].kept for i in range(60)) >= 57
    assert got[200].kept and got[200].perplexity is None and got[201].kept and got[202].kept
    assert kneser_ney.classify(odd, labels).count() == 9 and kneser_ney.classify(none, labels).count() == 0


def plain_kneser_ney(texts, order=5):
    """Interpolated modified Kneser-Ney of characters with dictionaries: a function of (context, character)."""
    tables = {order: collections.Counter()}
    for t in texts:
        padded = "\x02" * (order - 1) + t
        tables[order].update(padded[i : i + order] for i in range(len(t)))
    for n in range(order - 1, 0, -1):
        tables[n] = collections.Counter(g[1:] for g in tables[n + 1])
    off, contexts = {}, {}
    for n, table in tables.items():
        times = collections.Counter(table.values())
        y = times[1] / (times[1] + 2 * times[2]) if times[1] + times[2] else None
        for k in (1, 2, 3):
            d = k - (k + 1) * y * times[k + 1] / times[k] if y is not None and times[k] else -1
            off[n, k] = d if 0 < d < k else k / 2
        for g, c in table.items():
            total, taken = contexts.get(g[:-1], (0, 0.0))
            contexts[g[:-1]] = total + c, taken + off[n, min(c, 3)]

    def p(context, letter):
        n = len(context) + 1
        low = p(context[1:], letter) if n > 1 else 1 / (len(tables[1]) + 1)
        if context not in contexts:
            return low
        total, taken = contexts[context]
        c = tables[n][context + letter]
        return (c - off[n, min(c, 3)] if c else 0) / total + taken / total * low

    return lambda t: sum(np.log(p(("\x02" * (order - 1) + t)[i : i + order - 1], t[i])) for i in range(len(t)))


def test_kneser_ney_by_dictionaries(spark, monkeypatch):
    rnd = random.Random(12)
    rows = [(i, prose(rnd, rnd.randint(5, 40)) + rnd.choice(["", "é", " ☃"]), "en") for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    good = spark.range(50).selectExpr("id AS doc_id", "1 AS quality")
    table = kneser_ney.train(frame, good)
    held = {r.doc_id for r in spark.range(50).withColumnRenamed("id", "doc_id").where(kneser_ney._held_out()).collect()}
    score = plain_kneser_ney([t for i, t, _ in rows if i not in held])
    for most in (kneser_ney.MODEL_ROWS, 0):
        monkeypatch.setattr(kneser_ney, "MODEL_ROWS", most)
        got = {r.doc_id: r.logp for r in kneser_ney.log_probabilities(frame, table, id_col="doc_id", text_col="text", lang_col="lang").collect()}
        assert len(held) > 10 and all(got[i] == pytest.approx(score(t), rel=1e-9) for i, t, _ in rows)


def test_kneser_ney_trains_on_all_trusted(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "MODEL_ROWS", 0)
    rows = [(i, f"{chr(0x4E00 + i)} some words", "en") for i in range(2600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = kneser_ney.train(frame, spark.range(2600).selectExpr("id AS doc_id", "1 AS quality"))
    letters = {r.g for r in table.where("n = 1 AND logp IS NOT NULL").collect()}
    assert sum(c >= chr(0x4E00) for c in letters) > 1200
    shard = scorer_of(table)
    got = kneser_ney.log_probabilities(frame, table, most=9_000, id_col="doc_id", text_col="text", lang_col="lang").collect()
    assert len(got) == 2600 and all(r.logp == pytest.approx(shard.score("en", rows[r.doc_id][1])) for r in got)


# --- packing ---------------------------------------------------------------------------------------


def test_plan_places_every_piece_once():
    rnd = random.Random(12)
    counts = {x: rnd.randint(1, 9) for x in rnd.sample(range(1, 1025), 300)}
    bins = collections.Counter()
    for length, a, b, n, first, _ in bin_slack.plan(counts):
        for k in range(a, b):
            bins[first + (k - a) // n] += length
    assert sum(bins.values()) == sum(x * n for x, n in counts.items()) and max(bins.values()) <= 1024
    # No two pieces over half a sequence share one.
    assert len(bins) <= max(-(-sum(bins.values()) // 1024), sum(n for x, n in counts.items() if x > 512)) + 8
    assert bin_slack.fullest({5: 2, 7: 1, 9: 3}, 19) == {5: 2, 9: 1} and bin_slack.fullest({}, 10) == {}


def test_packing(spark, odd, none):
    rnd = random.Random(13)
    theirs = Tokenizer.from_file(TOKENIZER[0])
    own = bin_slack.encoder(*TOKENIZER)
    for _ in range(400):
        some = [fuzz(rnd, 40), fuzz(rnd, 40)]
        assert [np.frombuffer(x, "<u4").tolist() for x in own(some)] == [theirs.encode(t, add_special_tokens=False).ids for t in some]
    rows = [(i, prose(rnd, rnd.choice([5, 50, 500, 3000]))) for i in range(60)]
    got = bin_slack.pack(docs_of(spark, rows), TOKENIZER).toPandas()
    for i, t in rows:
        ids = [*theirs.encode(t, add_special_tokens=False).ids, 2]
        mine = got[got.doc_id == i].sort_values("piece")
        assert mine.length.sum() == len(ids) and (mine.length[1:] == 1024).all()
        assert [zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in mine.itertuples()] == list(mine.ids_crc32)
    packed = got.sort_values(["sequence_id", "offset"])
    ends = packed.groupby("sequence_id").length.cumsum()
    assert (ends - packed.length == packed.offset).all() and ends.max() <= 1024
    made = bin_slack.pack(odd, TOKENIZER).collect()
    assert sorted({str(r.doc_id) for r in made}) == ["1", "2", "3", "4", "5", "6", "7", "None"] and [r.length for r in made if r.doc_id == 1] == [1]
    assert bin_slack.pack(none, TOKENIZER).count() == 0


# --- line templates -----------------------------------------------------------------------------------


def test_line_templates(spark, odd, none):
    rnd = random.Random(14)
    rows = []
    for i in range(40):
        lines = [prose(rnd, 12), "Posted on 2024-01-%02d by admin%d" % (i % 28, i), "Share this page with " + rnd.choice(WORDS) + " and all your friends", prose(rnd, 9), ""]
        rows.append((i, "\n".join(lines)))
    rows += [(50, "copied line of text\nand more of it here")] * 30
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(docs_of(spark, rows), counts=True).collect()}
    assert got[0].text == rows[0][1] and got[0].n_dropped == 0  # the first keeps them
    for i, t in rows[1:40]:
        lines = t.split("\n")
        assert got[i].text == "\n".join([lines[0], lines[3], ""]) and got[i].n_dropped == 2
    assert got[50].n_dropped == 0  # copies of one text count once
    passage = prose(rnd, 50)
    long = [(i, f"{prose(rnd, 5)}\n{passage} {i}\n{prose(rnd, 19)}") for i in range(3)] + [(3, f"short of it\n{rows[1][1]}"), (4, "short of it")]
    left = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(docs_of(spark, long)).collect()}
    assert left[0] == long[0][1] and left[4] == "short of it" and all(left[i].split("\n") == long[i][1].split("\n")[::2] for i in (1, 2))
    kept = line_templates.drop_recurring_lines(odd)
    assert tuples(kept) == tuples(odd) and kept.columns == odd.columns and line_templates.drop_recurring_lines(none).count() == 0


def test_ranked_vocabulary_is_the_tokenizers():
    vocabulary = Tokenizer.from_file(TOKENIZER[0]).get_vocab()
    with open(TOKENIZER[1], "rb") as lines:
        ranks = [int(line.split()[1]) for line in lines if base64.b64decode(line.split()[0]).isalpha()]
    assert set(ranks) <= set(vocabulary.values())
