"""Each operator on small tables: brute force, nulls, empties, ties, repeats, empty tables, clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citeloom.llm import decontaminate, langid, packing, privacy, quality, simhash, substring_dedup, textops, token_files, tokens, topk, toxicity
from citeloom.llm.components import connected

SCHEMA = "doc_id long, text string, lang string, source string, k string, fp string, h string, words string, class_id string"


def docs(spark, *rows, lang="en"):
    """Rows of (doc_id, text), with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, "s", "k", "fp", "h", "w", "c") for i, t in rows], SCHEMA)


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    shared = [" ".join(rng.choices(vocab, k=rng.randint(20, 70))) for _ in range(5)]
    out = []
    for i in range(n):
        parts = [" ".join(rng.choices(vocab, k=rng.randint(0, 50))) for _ in range(3)]
        for s in rng.sample(shared, rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), s)
        out.append((i * 3 % n if n % 3 else i, rng.choice([" ", "\n", "\t "]).join(parts)))
    first = out[0][1]
    return [*out, (900, first), (901, first), (902, "x " * 100), (903, None), (904, ""), (905, " \n "), (906, "a\x85b c"), (907, " ".join(vocab * 12))]


def brute_dedup(rows, k=20):
    """Rows of equal id are judged against smaller ids and themselves."""
    out, seen = [], set()
    for i in sorted({r[0] for r in rows}):
        fresh = set()
        for _, text in [r for r in rows if r[0] == i]:
            w, own, gone = re.findall(r"[^\x20\x09-\x0D]+", text or ""), set(), set()
            for j in range(len(w) - k + 1):
                x = tuple(w[j : j + k])
                if x in seen or x in own:
                    gone.update(range(j, j + k))
                own.add(x)
            fresh |= own
            out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
        seen |= fresh
    return sorted(out)


def test_substring_dedup(spark):
    rows = corpus()
    rows += [(5, rows[7][1]), (5, rows[7][1])]  # repeated ids, one of them an own copy
    got = substring_dedup.dedup_substrings(docs(spark, *rows), chunk=3).select("doc_id", "n_words", "n_removed", "kept_text")
    assert sorted(map(tuple, got.collect())) == brute_dedup(rows)
    assert substring_dedup.dedup_substrings(docs(spark, *rows).limit(0)).count() == 0


def test_substring_dedup_many_null_ids(spark):
    rows = corpus(11, 30)
    rows += [(None, t) for _, t in rows[:20]] * 3 + [(None, "w1 w2 " * 30), (None, None), (None, "")]
    got = substring_dedup.dedup_substrings(docs(spark, *rows), chunk=4).select("doc_id", "n_words", "n_removed", "kept_text")
    want = brute_dedup([(substring_dedup.LAST if i is None else i, t) for i, t in rows])
    assert sorted((substring_dedup.LAST if r[0] is None else r[0], *r[1:]) for r in got.collect()) == want


def test_substring_dedup_survives_hash_collisions(spark):
    rows = corpus(12, 40)
    got = substring_dedup.dedup_substrings(docs(spark, *rows), bits=8).select("doc_id", "n_words", "n_removed", "kept_text")
    assert sorted(map(tuple, got.collect())) == brute_dedup(rows)


def test_paths_end_at_branches(spark):
    """Edges 1-2-3-4 in a row at the source; edge 9 enters the node between 2 and 3, so the path is cut there."""
    rows = [(1, 10, 11, 5, 0), (2, 11, 12, 5, 1), (3, 12, 13, 5, 2), (4, 13, 14, 5, 3), (9, 70, 12, 6, 8)]
    table = spark.createDataFrame(rows, "h long, head long, tail long, k0 long, p0 long").withColumn("tag0", F.lit(""))
    assert sorted((r["h"], r["k0"], r["path"]) for r in substring_dedup._paths(table).collect()) == [(1, 5, 0), (2, 5, 0), (3, 5, 2), (4, 5, 2), (9, 6, 8)]


def brute_fingerprint(text):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[j : j + 3]) for j in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    rng, rows = random.Random(3), corpus(2, 40)
    base = [f"t{i}" for i in range(900)]
    for i in range(25):
        w = list(base)
        w[rng.randrange(900)] = f"z{i}"
        rows.append((1000 + i, " ".join(w).upper() if i % 2 else " ".join(w)))
    rows.append((None, rows[0][1]))
    got = {(r[0], r[1], r[2]) for r in simhash.near_duplicates(docs(spark, *rows)).collect()}
    fp = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (fp[a] ^ fp[b]).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
    least = {r: min(rows[j][0] for j in range(len(rows)) if root[j] == r and rows[j][0] is not None) for r in set(root)}
    assert got == {(rows[j][0], f"{fp[j]:016x}", least[root[j]]) for j in range(len(rows))}
    assert simhash.near_duplicates(docs(spark, *rows).limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    root = {x: x for p in links if p[0] != p[1] for x in p}
    for _ in root:
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(links, "u long, v long")).collect()}
    assert {x: got.get(x, x) for x in root} == root


def test_one_of_each(spark):
    rng = random.Random(4)
    text = [f"q{rng.randrange(3000)}" for _ in range(400)]
    near = list(text)
    near[200] = "changed"
    other = " ".join(f"q{rng.randrange(3000)}" for _ in range(400))
    rows = [(1, " ".join(text)), (2, " ".join(near)), (3, other), (4, other.upper()), (5, ""), (6, None), (7, " "), (8, "short one"), (9, "short two"), (None, other), (3, other)]
    got = simhash.one_of_each(docs(spark, *rows))
    assert got.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 3, 5, 8, 9]
    assert simhash.one_of_each(docs(spark, *rows).limit(0)).count() == 0


def brute_classes(rows, least=0.8, words=5):
    """Smallest id of those connected by pairs of shingle sets that are similar enough; and the pairs."""
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = frozenset(" ".join(w[j : j + words]) for j in range(max(1, len(w) - words + 1)))
    root, pairs, ids = {i: i for i in sets}, [], sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and min(len(sets[a]), len(sets[b])) >= least * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if both >= least * (len(sets[a]) + len(sets[b]) - both):
                    pairs.append((a, b))
    for a, b in pairs * 6:
        root[a] = root[b] = min(root[a], root[b])
    return root, pairs


def test_recall_of_similar_classes(spark):
    """Pairs from 0.8 upwards, alone, within a crowd that shares a template, and as short texts, against brute force."""
    rng, rows = random.Random(5), []
    word = lambda: f"v{rng.randrange(10**6)}"

    def edited(w, n):
        w = list(w)
        for j in rng.sample(range(0, len(w) - 1, 7), n):
            w[j] = word()
        return w

    for n, size in [(1, 45), (2, 100), (2, 100), (4, 210), (5, 210), (1, 60), (2, 130), (3, 200)]:
        for _ in range(25):
            base = [word() for _ in range(size)]
            rows += [base, edited(base, n)]
    template = [word() for _ in range(240)]
    crowd = [edited(template, 6) for _ in range(250)]  # mutual similarity of 0.6 to 0.7
    rows += crowd + [edited(w, 2) for w in crowd[:60]]
    for size in (8, 9, 12, 20):  # one shingle more or less
        for _ in range(25):
            base = [word() for _ in range(size)]
            rows += [base, [*base, word()]]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    want, pairs = brute_classes(rows)
    got = {r["id"]: r["class_id"] for r in simhash.similar_classes(spark.createDataFrame(rows, "id long, text string"), block=16).collect()}
    assert len(pairs) > 250
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.95 * len(pairs)
    short = [(a, b) for a, b in pairs if len(rows[a][1].split()) <= 50]
    assert short and all(got[a] == got[b] for a, b in short)
    crowded = [(a, b) for a, b in pairs if 400 <= a < 710]
    assert len(crowded) >= 60 and sum(got[a] == got[b] for a, b in crowded) >= 0.95 * len(crowded)
    assert all(want[i] == want[c] for i, c in got.items())  # nothing dissimilar is joined


def test_similar_classes_miss_no_pair(spark):
    """Pairs of long texts just above 0.8, and texts that of a large class of near copies resemble one member alone."""
    rng, rows = random.Random(8), []
    word = lambda: f"z{rng.randrange(10**6)}"

    def changed(w, at):
        return [word() if j in at else x for j, x in enumerate(w)]

    for _ in range(240):  # five shingles fewer a change
        n = rng.randrange(7, 13)
        base = [word() for _ in range(n * 45 + 4)]
        rows += [base, changed(base, {45 * j + 22 for j in range(n)})]
    head = [word() for _ in range(304)]
    for j in range(40):
        member = changed(head, {150, 4 + 7 * j})
        rows += [member, changed(member, {11, 61, 111, 191, 241, 291} - {4 + 7 * j})]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    rng.shuffle(rows)
    want, pairs = brute_classes(rows)
    got = {r["id"]: r["class_id"] for r in simhash.similar_classes(spark.createDataFrame(rows, "id long, text string"), block=16).collect()}
    assert len(pairs) >= 240 and got == want


def test_signatures_are_shared_by_similar_sets():
    """Random pairs at and above the least similarity, of all sizes; the parity bitmap refuses none of them."""
    rng = np.random.default_rng(2)
    tops = simhash._sizes(0.8, 4000)
    for n in [*range(1, 60), *rng.integers(60, 1500, 200).tolist()]:
        for _ in range(4):
            most = int(n / 0.8 + 1e-9)
            size = int(rng.integers(n, most + 1))
            both = -(-4 * (n + size) // 9)  # the least overlap of a similarity of 0.8
            words = np.unique(rng.integers(0, 2**64, n + size - both + 9, np.uint64))
            rng.shuffle(words)
            a, b = np.sort(words[:n]), np.sort(words[n - both : n + size - both])
            assert len(np.intersect1d(simhash.signatures(a, 0.8, tops), simhash.signatures(b, 0.8, tops))), (n, size)
            differ = (simhash._mark(a)[1:] ^ simhash._mark(b)[1:]).view(np.uint64)
            assert int(np.bitwise_count(differ).sum()) <= len(np.setxor1d(a, b))


def test_a_crowd_is_compared_by_a_row_per_member(spark):
    """60 texts under one value, 1,770 pairs: every pair is listed once, in a row per member and group, and few links join them."""
    step, n = simhash.Scratch(spark), 60
    rows = spark.range(n).selectExpr("7L as value", "id", "id as class", "0L as mark")
    for block, most in ((128, n), (16, 5 * n)):
        groups = simhash._met(rows, lambda x, y: x == y, block, f"crowd{block}", step).collect()
        listed = sorted((r["id"], m) for r in groups for m in r["mates"])
        assert listed == [(u, v) for u in range(n) for v in range(u)]
        assert len(groups) <= most
        assert all({m for r in groups if r["key"] == k for m in r["mates"]} <= {r["id"] for r in groups if r["key"] == k} for k in {r["key"] for r in groups})
    texts = spark.range(5000).selectExpr("id", f"if(id < {n}, 'one text of seven words for all', concat('text ', id)) as text")
    groups = simhash._met(rows, lambda x, y: x == y, 128, "crowd", step)
    links = simhash._verified(texts, groups, 5, 0.8, "crowd", step).collect()
    assert len(links) == n - 1 and {x for r in links for x in r} == set(range(n))
    held = {r["id"] for r in simhash._holding(texts, groups.select("id")).collect()}
    assert set(range(n)) <= held and len(held) < 400


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    own, whole = tokens.PieceEncoder(tokens.tokenizer_path(), 50), Tokenizer.from_file(tokens.tokenizer_path())
    whole.encode_special_tokens = True
    rng = random.Random(3)
    bits = ["a", "B", "é", " ", "  ", "\n", "\t", " \n", "'s", "'ll", "1", "12", "!", "?!", "\x1c", "\x85", "\xa0", "　", "日本", "😀", "<|endoftext|>", "_", "́", "²", "\r\n", "word", " word,"]
    for text in [t or "" for _, t in corpus(5, 20)] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(3000)]:
        assert own.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_pieces_met_lately_are_kept_and_their_number_is_bounded():
    """A piece met every 30 others is encoded once, however many others come by; at most twice ``most`` are held."""
    own, made = tokens.PieceEncoder(tokens.tokenizer_path(), 50), []
    word = own.word
    own.word = lambda w: made.append(w) or word(w)
    for i in range(3000):
        own.encode(f" q{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i // 100 % 10]}{'abc'[i // 1000]}")
        if i % 30 == 0:
            own.encode(" recurring recurring.\nRecurring!!")
        assert len(own) + len(own.older) <= 100
    assert made.count(tokens.SPACE_LETTER + "recurring") == 1


def test_columns_are_encoded_as_the_tokenizer_encodes_their_texts():
    """Cuts between letters, digits, signs and white space of every kind change no id; nulls, empty texts and slices keep their place."""
    from tokenizers import Tokenizer

    own, whole = tokens.PieceEncoder(tokens.tokenizer_path(), 300), Tokenizer.from_file(tokens.tokenizer_path())
    whole.encode_special_tokens = True
    rng = random.Random(11)
    bits = ["a", "B", "é", "Éß", "ÿ", "×", "÷", "ªµ", "Ж", "٠", "'", "''", "'s", "'T", "'re", "1", "12", "!", "$$", "_", "—", "“", "日", "😀", "\u0301", "\u200b", "\ufeff"]
    bits += [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x00", "\x1c", "\x1f", "\x7f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", " word,", "<|endoftext|>"]
    for size in (0, 1, 7, 3000):
        texts = [rng.choice([None, ""]) if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(size)]
        ids, off = own.encode_column(pa.array(["left out, é", None, *texts], pa.string()).slice(2), np.array([7, 0], "<u4").tobytes())
        for i, t in enumerate(texts):
            assert ids[off[i] : off[i + 1]].tolist() == [*whole.encode(t or "", add_special_tokens=False).ids, 7, 0], repr(t)
        assert len(off) == size + 1 and off[-1] == len(ids)
    assert own.encode(None) == own.encode("") == b""


class CountedEncoder(tokens.PieceEncoder):
    asked = 0

    def __getitem__(self, piece):
        self.asked += 1
        return super().__getitem__(piece)


def asked_by(monkeypatch, module, run):
    """Lookups of pieces for 200 texts of 800 words, in one task."""
    from types import SimpleNamespace

    own = CountedEncoder(tokens.tokenizer_path(), 1000)
    monkeypatch.setattr(tokens.PieceEncoder, "get_one", lambda *_: own)
    monkeypatch.setattr(module, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    text = " ".join(["some words, recurring: again."] * 200)
    out = list(run(iter([pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array([text] * 200)], ["doc_id", "text"])])))
    assert sum(len(b.column("ids").flatten()) for b in out) == 200 * (len(own.encode(text)) // 4 + 1)
    return own.asked


def test_packing_looks_up_the_distinct_pieces_of_a_batch(monkeypatch):
    assert asked_by(monkeypatch, packing, packing._pack(tokens.tokenizer_path(), 1024, 1 << 20)) < 100


def test_token_files_look_up_the_distinct_pieces_of_a_batch(monkeypatch):
    assert asked_by(monkeypatch, token_files, token_files._encode(tokens.tokenizer_path())) < 100


def expected_ids(rows):
    own = tokens.PieceEncoder.get_one(tokens.tokenizer_path())
    return {i: own.encode(t) + b"\0\0\0\0" for i, t in rows}


def test_token_files(spark, tmp_path):
    rows = corpus(6, 30)
    token_files.write_token_files(docs(spark, *rows), str(tmp_path / "t"), partitions=3)
    back = token_files.read_token_files(spark, str(tmp_path / "t"))
    at, want, ids = 0, [], expected_ids(rows)
    for i in sorted(ids):
        want.append((i, at, len(ids[i]) // 4, zlib.crc32(ids[i])))
        at += len(ids[i]) // 4
    assert sorted(map(tuple, token_files.with_checksums(back).collect())) == want
    assert len(back.where("doc_id = 901").first()["ids"]) == len(ids[901]) // 4
    token_files.write_token_files(docs(spark, *rows).limit(0), str(tmp_path / "e"))
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_packing(spark):
    rows = corpus(7, 30) + [(None, "no id"), (950, "very long " * 3000)]
    ids, got = expected_ids(rows), packing.pack(docs(spark, *rows).coalesce(1), group=20_000).collect()
    cover, rooms = {}, {}
    for p in got:
        raw = ids[p["doc_id"]][4 * p["start"] : 4 * (p["start"] + p["length"])]
        assert np.array(p["ids"], "<u4").tobytes() == raw and zlib.crc32(raw) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]]) // 4
        cover.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        rooms.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts, whole in [(v, len(ids[i]) // 4) for i, v in cover.items()] + [(v, None) for v in rooms.values()]:
        end = 0
        for a, n in sorted(parts):
            assert a == end and n > 0
            end += n
        assert end == whole if whole is not None else end <= 1024
    assert set(cover) == set(ids)
    assert len(rooms) * 1024 - sum(map(len, ids.values())) // 4 < 1024 * (1 + sum(map(len, ids.values())) // 4 // 20_000)
    assert packing.pack(docs(spark, *rows).limit(0)).count() == 0


def test_balanced_costs():
    pieces = packing.balance([600, 500, 400, 300, 200, 48], 1024)
    per = {}
    for _, _, n, s, _ in pieces:
        per[s] = per.get(s, 0) + n
    assert len(per) == 2 and sum(per.values()) == 2048


def brute_windows(rows, bench, size=10):
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    win = {}
    for item, t in bench:
        w = low(t) if item is not None else []
        n = min(size, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            win.setdefault(tuple(w[j : j + n]), set()).add(str(item))
    out = []
    for i, t in rows:
        w, hit, items = low(t), set(), set()
        for n in {len(x) for x in win}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in win:
                    hit.update(range(j, j + n))
                    items |= win[tuple(w[j : j + n])]
        out.append((i, len(w), len(hit), len(items), sorted(items), bool(hit)))
    return sorted(out, key=repr)


def test_decontamination(spark):
    rng = random.Random(8)
    item = [f"B{i}" for i in range(30)]
    bench = [(11, " ".join(item)), (2, "Tiny Item"), (3, "É solo"), (4, ""), (5, None), (None, "w1 w2"), (2, "Tiny Item"), (7, "42")]
    rows = corpus(9, 15) + [(i, " ".join(rng.choices(["é", "x", "É"], k=30)) + " " + ", ".join(item[i % 20 : i % 20 + 10 + i % 3]).lower() + "! tiny-ITEM É  solo") for i in range(500, 512)] + [(520, "the 42."), (521, "B1 B2")]
    table = spark.createDataFrame(bench, "item_id long, text string")
    clash = docs(spark, *rows).withColumns({"_words": F.lit("a"), "_hits": F.lit("b"), "_one": F.lit("c"), "row": F.lit("d")})
    got = sorted((tuple(r) for r in decontaminate.report(clash, table, block=4).collect()), key=repr)  # several tables, in passes
    assert got == brute_windows(rows, bench)
    got = sorted((tuple(r) for r in decontaminate.report(docs(spark, *rows), table).collect()), key=repr)
    assert got == brute_windows(rows, bench)
    clean = decontaminate.without_spans(clash, table)
    assert clean.columns == clash.columns and clean.first()["_hits"] == "b"
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[520] == "the " and texts[903] is None and texts[904] == "" and texts[521] == "B1 B2"
    assert decontaminate.report(docs(spark, *rows), table.limit(0)).where("contaminated").count() == 0
    assert decontaminate.report(docs(spark, *rows).limit(0), table).count() == 0


def test_a_list_of_windows_that_many_rows_hold_is_dealt(spark):
    lists = [[["a", "b"]]] * 40 + [[["c", str(i % 30)]] for i in range(60)]
    out = spark.createDataFrame([(i, 2, 2, x) for i, x in enumerate(lists)], "id long, n_words long, n_hit long, held array<array<string>>")
    found = spark.createDataFrame([(x, [str(x[0][1])]) for x in lists[39:70]], "held array<array<string>>, items array<string>")
    got = decontaminate._dealt(out, found, most=4, salts=3).collect()
    assert sorted((r["id"], r["items"]) for r in got) == [(i, [x[0][1]]) for i, x in enumerate(lists)]


def test_privacy(spark):
    text = "Mr. John Smith met Mrs Anna Keller; Herr Keller, John Smith. +1 (017) 555-7713 or +1 017 555 7713, 4111 1111 1111 1111, 4111111111111111. 10.0.0.7 x.y1@mail.example.com X.Y1@MAIL.EXAMPLE.COM Иван Петров token = \"0123456789abcdef0123456789abcdef\""
    rows = [(1, text), (2, text), (3, None), (4, ""), (5, "nothing here 1990-2020, v1.2, 9807915762804490, 999.1.1.1, 1234567812345678"), (6, "mail b@c.de")]
    clash = docs(spark, *rows).withColumns({c: F.lit("own") for c in ("_found", "_new", "found", "known", "row", "pattern", "_entities")})
    changed = privacy.pseudonymise(clash, "key", "_entities")
    assert sorted(changed.columns) == sorted(clash.columns)
    got = {r["doc_id"]: r for r in changed.collect()}
    assert all(r["_found"] == r["found"] == r["known"] == "own" for r in got.values())
    assert got[1]["text"] == got[2]["text"] and [got[i]["text"] for i in (3, 4, 5)] == [None, "", rows[4][1]] and got[5]["_entities"] == 0
    new = got[1]["text"]
    for secret in ("Smith", "Anna", "Keller", "555-7713", "4111", "10.0.0.7", "x.y1@", "Иван", "0123456789abcdef"):
        assert secret not in new
    found = [e for e in re.split(r"[;,] | met | or |\. (?=[+1])| (?=X|Иван|token)", new)]
    one, two = re.findall(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1 (\d{3}) (\d{3}) (\d{4})", new)[0][:3], re.findall(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1 (\d{3}) (\d{3}) (\d{4})", new)[0][3:]
    assert one == two and found
    cards = [re.sub(" ", "", c) for c in re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", new)]
    assert cards[0] == cards[1] and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(cards[0]))) % 10 == 0
    mails = re.findall(r"\S+@\S+\.\S+", new)
    assert mails[0].lower() == mails[1].lower() and mails[1].isupper() and mails[0].endswith(".com")
    first = re.search(r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+); Herr (\w+), (\w+) (\w+)\.", new)
    assert first and first[1] == first[6] and first[2] == first[7] and first[4] == first[5] and first[3].endswith("na")
    assert re.search(r"[Ѐ-ӿ]{5,} [Ѐ-ӿ]{5,}", new)
    other = privacy.pseudonymise(docs(spark, *rows), "other key").where("doc_id = 1").first()["text"]
    assert other != new
    assert privacy.pseudonymise(docs(spark, *rows).limit(0), "key").count() == 0


def test_bare_mentions_follow_their_person(spark):
    text = "John Smith wrote it. Later Smith called John. Dr. Keller and Yuki Tanaka met; Tanaka left Keller's house with Mr. Alex Bauer. Alex stayed."
    rows = [(1, text), (2, "Smith is a word of its own here, and so is Keller."), (3, "hash deadbeefcafebabefacefeeddeadbeef"), (4, "x" * 90 + "@mail.example.com and " + "q" * 60 + "@mail.example.com")]
    got = {r["doc_id"]: r["text"] for r in privacy.pseudonymise(docs(spark, *rows), "key").collect()}
    new = got[1]
    for word in "John Smith Keller Yuki Tanaka Alex Bauer".split():
        assert not re.search(rf"\b{word}\b", new)
    m = re.fullmatch(r"(\w+) (\w+) wrote it. Later (\w+) called (\w+). Dr. (\w+) and (\w+) (\w+) met; (\w+) left (\w+)'s house with Mr. (\w+) (\w+). (\w+) stayed.", new)
    assert m and m[1] == m[4] and m[2] == m[3] and m[5] == m[9] and m[7] == m[8] and m[10] == m[12]
    assert got[2] == rows[1][1] and "deadbeef" not in got[3] and len(got[3]) == len(rows[2][1])
    local = got[4].split(" and ")[1].split("@")[0]
    assert len(set(local[i : i + 20] for i in range(0, 60, 20))) == 3  # draws do not recur


def test_surrogates_are_keyed_by_hmac(spark):
    import hmac

    got = spark.range(1).select(privacy._mac("secret", F.lit("message")), privacy._mac("k" * 100, F.lit("m"))).first()
    assert tuple(got) == (hmac.new(b"secret", b"message", "sha256").hexdigest(), hmac.new(b"k" * 100, b"m", "sha256").hexdigest())


def test_surrogates_stay_distinct(spark):
    """Addresses so short that draws must collide: the attempts part them."""
    many = docs(spark, *[(i, f"{c}@{d}.de") for i, (c, d) in enumerate((c, d) for c in "abcdefghij" for d in "abcde")])
    got = [r["text"] for r in privacy.pseudonymise(many, "k").collect()]
    real = {r["text"] for r in many.collect()}
    assert len(set(got)) == 50 and not set(got) & real


def test_topk(spark):
    rng = np.random.default_rng(1)
    vec = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(0, 330)]
    vec[10] = (10, vec[11][1])
    vec += [(12, vec[12][1]), (400, None), (500, [1.0, None] * 4), (600, [float("nan")] * 8), (None, [1.0] * 8), (700, [float("inf")] * 8)]
    df = spark.createDataFrame(vec, "vec_id long, embedding array<float>").withColumn("cell", F.lit("x")).withColumn("score", F.lit("y"))
    q = df.where("vec_id % 100 = 0")
    got = sorted(tuple(r) for r in topk.top_k(df, q, k=10, pivots=7).collect())
    sound = [(i, np.floor(np.array(v, np.float32).astype(float) * 1024).astype(int)) for i, v in vec if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, v in sound:
        if i % 100 == 0:
            best = sorted(((-int(v @ w), j) for j, w in sound if j != i))[:10]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert got == sorted(want)
    assert topk.top_k(df.limit(0), q.limit(0)).count() == 0


def test_topk_beyond_64_bits():
    q, x = np.array([[2**40, 2**40]]), np.array([[2**40, 2**40], [1, 2]])
    assert topk._products(q, x).tolist() == [[2**63 - 1, 3 * 2**40]]


def test_toxicity():
    rng = random.Random(2)
    word = lambda: f"n{rng.randrange(500)}"

    def make(bad):
        return " ".join([word() for _ in range(30)] + (["insult", "group"] if bad else [rng.choice(["insult", "group", "plain"])]))

    sample = [(make(i % 3 == 0), int(i % 3 == 0)) for i in range(1500)]
    model = toxicity.fit(sample, epochs=60)
    score = lambda t: model.score(model.rows(t, {}))
    # the pair is toxic, neither word alone is
    assert score("insult group n1") > 0.5 > max(score("insult n1"), score("group n2"), score(""), score(None))
    assert toxicity.fit([]).score([]) == 0.5 and toxicity.fit([("a", 1)]).score([]) > 0.5


def test_toxicity_on_tables(spark):
    """The Spark path: held-out rows, nulls, empties, repeats, clashing columns, empty tables; brute force by the machine itself."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"n{rng.randrange(300)}" for _ in range(20)) + (" insult group" if i % 3 == 0 else "")) for i in range(600)]
    odd = [(700, None), (701, ""), (0, rows[0][1]), (None, "insult group"), (702, "insult group " * 5000)]
    table = docs(spark, *rows, *odd).withColumns({"_score": F.lit("x"), "score": F.lit("y"), "held_out": F.lit("z")})
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(600)] + [(None, 1, 1), (0, 0, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(table, labels).collect()
    assert len(out) == 605 and out[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    held = [r for r in out if r["held_out"] and r["doc_id"] < 600]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held]) > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out if r["doc_id"] is not None)
    model = toxicity.fit_on(table, labels)
    texts = dict(rows + odd)
    assert all(abs(r["score"] - model.score(model.rows(texts[r["doc_id"]], {}))) < 1e-12 for r in out)
    kept = toxicity.clean(table, model)
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in out if r["predicted"] == 0}
    assert toxicity.toxicity(table.limit(0), labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(table, labels.limit(0)).collect()} == {0.5}


def test_sample_is_bounded(spark):
    from citeloom.llm.learn import labelled_sample

    many = spark.createDataFrame([(1, f"t{i}") for i in range(900)] + [(2, "b"), (3, "x" * 300)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)] * 100 + [(2, 1), (3, 1)], "doc_id long, toxic int")
    assert labelled_sample(many, labels, "toxic", 10_007, -1, 100, longest=200) == [("t0", 0), ("b", 1)]


def test_quality(spark):
    rng = np.random.default_rng(0)
    first = np.array([0, 3, 3, 4, 8])
    node, trans, begin = rng.normal(size=(8, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    good, pairs, z = quality.forward_backward(node, first, trans, begin)
    import itertools

    want, both = np.zeros(8), np.zeros((2, 2))
    for d in range(4):
        n, total, acc, pp = first[d + 1] - first[d], 0.0, np.zeros(first[d + 1] - first[d]), np.zeros((2, 2))
        for s in itertools.product((0, 1), repeat=int(n)) if n else []:
            e = np.exp(begin[s[0]] + sum(node[first[d] + i, s[i]] for i in range(n)) + sum(trans[s[i], s[i + 1]] for i in range(n - 1)))
            total, acc = total + e, acc + e * np.array(s)
            for i in range(n - 1):
                pp[s[i], s[i + 1]] += e
        if n:
            want[first[d] : first[d + 1]], both = acc / total, both + pp / total
    assert np.allclose(good, want) and np.allclose(pairs, both)
    fine, junk = "A calm sentence of plain words.\nAnother one follows here.", "BUY!! NOW!!\n### $$$ %%%\nBUY!! NOW!!"
    model = quality.fit([(fine, 1), (junk, 0)] * 40)
    table = docs(spark, (1, fine), (2, junk), (3, None), (4, ""), (5, "x" * 100_000))
    import pyarrow as pa

    scores = model.scores(*quality.features(pa.array([fine, junk, None, ""])))
    assert scores[0] >= 0.7 > scores[1] and scores[2] == scores[3] == 0.5
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0)], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in quality.quality(table, labels).orderBy("doc_id").collect()] == [0.5] * 5


def test_langid(spark):
    x, _ = langid.byte_rows([b"abc", b"de", b"fghij"])
    y, w = np.array([0, 1, 1]), np.array([1.0, 2.0, 0.5])
    m = langid.fit([("the of and", "en"), ("der die das", "de")], hidden=3, epochs=0)
    m.p = {k: v.astype(float) for k, v in m.p.items()}

    def loss():
        p, mask = m.labels(x), (x.T > 0) * w
        return -(np.log(p[:, np.arange(3), y]) * mask).sum() / mask.sum()

    grads, rng = m.gradients(x, y, w), np.random.default_rng(0)
    for k, v in m.p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in v.shape)
            old, d = v[at], 1e-5
            v[at] = old + d
            up = loss()
            v[at] = old - d
            down = loss()
            v[at] = old
            assert abs((up - down) / (2 * d) - grads[k][at]) < 1e-7
    english, german = "the of and that with this from have which".split(), "der die und das nicht mit ein auf für".split()
    r = random.Random(1)
    rows = [(i, " ".join(r.choices(english if i % 2 else german, k=40)), "en" if i % 2 else "de") for i in range(200)]
    rows += [(1000, None, "en"), (1001, "", None), (1002, "123 --- !!", "de"), (1003, "the " * 20_000, "en")]
    out = {x["doc_id"]: x for x in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1)), rows=100).collect()}
    held = [i for i, *_ in rows[:200] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(out[i]["held_out"] for i in held) and np.mean([out[i]["lang_pred"] == rows[i][2] for i in held]) > 0.95
    assert [out[i]["lang_pred"] for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "en"] and all(0 <= x["score"] <= 1 for x in out.values())


def test_held_out_buckets(spark):
    from citeloom.llm.learn import bucket

    rows = spark.range(50).select("id", bucket("id", 5).alias("b")).collect()
    assert all(r["b"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


@pytest.mark.parametrize("k", [1, 2, 3, 7, 20])
def test_window_hashes(k):
    from citeloom.llm import textops

    h = np.random.default_rng(0).integers(0, 2**63, 60).astype(np.uint64)
    p = int(textops._P)
    want = [sum(int(h[i + j]) * pow(p, k - 1 - j, 2**64) for j in range(k)) % 2**64 for i in range(60 - k + 1)]
    assert [int(v) for v in textops.run_hashes(h, k)] == want
    assert textops.sliding_min(h, k).tolist() == [int(h[i : i + k].min()) for i in range(60 - k + 1)]


def test_digest_matches_contract(spark):
    r = substring_dedup.dedup_substrings(docs(spark, (1, "a b"))).select(F.sha2("kept_text", 256)).first()[0]
    assert r == hashlib.sha256(b"a b").hexdigest()


def test_top_k_deals_out_few_of_many_copies(spark):
    """Every copy of a vector was dealt out once a block of queries; only those of least ids can be in a result."""
    from pyspark.sql import functions as F

    one = spark.range(3).select(F.col("id").alias("g"), F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: ((F.col("id") + i) % 3 - 1) / F.lit(2.0)).alias("embedding"))
    rows = one.crossJoin(spark.range(60).withColumnRenamed("id", "c")).select((F.col("c") * 3 + F.col("g")).alias("vec_id"), "embedding")
    rows = rows.union(rows.where("vec_id = 0")).union(rows.where("vec_id = 0"))  # an id of three rows
    assert topk.least_copies(topk.quantised(rows), 4).count() == 3 * 5 + 2
    got = sorted(tuple(r) for r in topk.top_k(rows, rows.where("vec_id % 50 = 0"), 4).select("query_id", "rank", "vec_id", "score").collect())
    data = [(r["vec_id"], r["v"]) for r in topk.quantised(rows).collect()]
    want = []
    for q, v in sorted({(i, tuple(x)) for i, x in data if i % 50 == 0}):
        best = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in data if i != q)[:4]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == want


def test_needed_cells_carry_no_vectors():
    """A batch of queries gave its vectors once a cell, which grew by the cells' number; now ids alone, in slices."""
    import numpy as np
    import pandas as pd

    n = 2500
    frame = pd.DataFrame({"query_id": np.arange(n), "v": [np.array([1, 0])] * n, "cell": 0, "least": np.nan})
    out = list(topk._needed(np.array([[0.0, 1.0], [1.0, 0.0], [2.0, 2.0]]), np.array([1.0, 1.0, -1.0]), 2)(iter([frame])))
    assert [len(x) for x in out] == [1024, 1024, 452] and all(list(x.columns) == ["query_id", "cell"] and (x["cell"] == 1).all() for x in out)


def test_worker_memory(spark):
    """Tasks of other operators drop what packing keeps in its worker; the pipeline's stages send no batch of 10,000 long rows."""
    import pyarrow as pa

    import corpus_pipeline

    batch = pa.RecordBatch.from_pydict({"id": [1], "text": ["a b c d e f"]})
    for run in (simhash._sketches(5, 0.8, 3, 28), simhash._sets(5)):
        tokens.PieceEncoder.get_one(tokens.tokenizer_path(), 50)
        assert sum(b.num_rows for b in textops.lean(run)(iter([batch]))) == 1 and not textops.KEPT
    one = tokens.PieceEncoder.get_one(tokens.tokenizer_path(), 50)
    assert one is tokens.PieceEncoder.get_one(tokens.tokenizer_path(), 50)
    tokens.PieceEncoder.get_one(tokens.tokenizer_path(), 60)
    assert len(textops.KEPT) == 1

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"mb": [b.nbytes / 1e6]})

    long = spark.range(3000).repartition(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2000).alias("text"))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.packed):
        spark.conf.unset(name)
        stage(spark, docs(spark, (1, "a b")), None)
        assert max(r[0] for r in long.mapInArrow(sizes, "mb double").collect()) < 6
    spark.conf.set(name, "1000")
    textops.bounded_batches(spark)
    assert spark.conf.get(name).removesuffix("b") == "1000"
    spark.conf.unset(name)
