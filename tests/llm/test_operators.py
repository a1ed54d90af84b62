"""Each operator against a brute-force version or a round trip, on odd rows too."""

import random
import re
import zlib
from collections import Counter, defaultdict
from struct import pack

import numpy as np
import pytest
import xxhash

from corpusloom.llm import components, decontaminate, html_text, language, line_dedup, pieces, pii, sharding, simhash, token_counts, topk

SPACE = " \t\n\x0b\x0c\r"
LINE = "this line stands in many documents"


def texts() -> list[tuple]:
    rng = random.Random(5)
    words = ["alpha", "Beta", "gämma", "delta", "epsilon", "zeta,", "eta.", "theta", "▁iota", "κappa"]
    out = [(None, f"  {LINE.upper()} \nown line of a row without an id"), (0, None), (1, ""), (2, " \n\t"), (3, "\n\n")]
    out += [(4, "one"), (5, "ONE"), (6, LINE + "\n" + LINE), (7, f"{LINE}\t\nmore"), (8, LINE), (8, LINE)]
    base = " ".join(rng.choice(words) for _ in range(300))
    out += [(20 + i, base) for i in range(6)]
    out += [(30 + i, base.replace("delta", "omega", 1) + f" end{i}") for i in range(6)]
    out += [(40 + i, "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(5))) for i in range(25)]
    out += [(90, "long " * 40_000), (91, "x" * 5_000), (92, "\U0001f600é " * 50), (93, " " * 6_000 + "end")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, "id", [1], 7) for i, t in texts()]
    # Extra columns carry names that the operators use inside.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, ids array<int>, print long").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 3)]
    found = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    near = defaultdict(set)
    for a, b in edges:
        if a is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert found[node] == min(seen)
    assert set(found) == set(near)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(rows):
    key = lambda line: re.sub("[A-Z]+", lambda m: m[0].lower(), line.strip(SPACE))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and i != max(holders[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_line_dedup(docs, empty):
    got = Counter(tuple(r) for r in line_dedup.dedup_lines(docs).collect())
    assert got == brute_lines(texts())
    assert sum(n for (_, _, dropped, _), n in got.items() if dropped) >= 4
    assert line_dedup.dedup_lines(empty).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(2)
    h1, h2 = rng.integers(0, 2**64, 5000, dtype=np.uint64), rng.integers(0, 2**64, 5000, dtype=np.uint64)
    h1[:50] = h1[0]
    made = line_dedup.PerfectHash.build(h1, h2)
    assert sorted(made.places(h1, h2)) == list(range(5000))
    crowded = line_dedup.PerfectHash.build(h1[:0], h2[:0])
    assert list(crowded.places(h1[:2], h2[:2])) == [-1, -1]


def test_html_blocks():
    page = "<p>a<b>b</b> &amp;c<br>d<p>e</p><script>x='</p>'</script><!-- <p>no --><ul><li>f<li>g</ul>h < i <a href='>'>j</a><p>cut <foo"
    assert [b.text for b in html_text.blocks(page)] == ["ab &c d", "e", "f", "g", "h < i j", "cut"]
    assert html_text.blocks(None) == html_text.blocks("") == html_text.blocks("<div></div><!--") == []
    assert [b.text for b in html_text.blocks("<div>" * 3000 + "deep")] == ["deep"]


def test_html_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    model = html_text.train(pages)
    test = html_text.labelled_pages([r.html for r in pages.collect()][:30], 3, seed=11)
    wrong = sum(a != b.main for p in test for a, b in zip(model.decode(p), p, strict=True))
    assert wrong <= 0.01 * sum(map(len, test))
    odd = spark.createDataFrame([(None, None, None, 1), (1, "u", "", 2), (1, "u", "<article><p>Only  text.", 3), (2, "v", "word " * 50_000, 4)], "page_id long, url string, html string, text int")
    got = html_text.extract(odd, model).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in got][:3] == [(None, "", 0), (1, "", 0), (1, "Only text.", 10)]
    assert html_text.extract(pages.limit(0), html_text.train(pages.limit(0))).count() == 0
    # The chain's likelihood at its best path is what enumeration finds.
    page = test[0][:8]
    emit = [[sum(model.emit[f][y] for f in own if f in model.emit) for y in (0, 1)] for own in html_text.features(page)]
    best = max(range(2 ** len(page)), key=lambda n: sum(emit[i][n >> i & 1] for i in range(len(page))) + sum(model.move[n >> i & 1][n >> i + 1 & 1] for i in range(len(page) - 1)))
    assert model.decode(page) == [bool(best >> i & 1) for i in range(len(page))]


def brute_bits(trees_from, order, text):
    """Code length of one text by walking contexts, from dictionaries of counts."""
    count = defaultdict(Counter)
    for t in trees_from:
        raw = b"\0" * order + t.encode()
        for i in range(order, len(raw)):
            for k in range(order + 1):
                count[raw[i - k : i]][raw[i]] += 1
    bits, raw = 0.0, b"\0" * order + text.encode()
    for i in range(order, len(raw)):
        for k in range(order, -1, -1):
            seen = count.get(raw[i - k : i])
            if seen:
                n, d = sum(seen.values()), len(seen)
                if seen[raw[i]]:
                    bits += np.log2((n + d) / seen[raw[i]])
                    break
                bits += np.log2((n + d) / d)
        else:
            bits += 8
    return bits


def test_language_code_lengths(spark):
    known = {"aa": ["the cat sat", "the mat"], "bb": ["der hut", "die katze saß"]}
    rows = [(i, t, lang) for lang, ts in known.items() for i, t in enumerate(ts)]
    trees = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    import pyarrow as pa

    asked = ["the hat", "", "saß", "zzz€", None, "x" * 50]
    bits = language.code_lengths(trees, pa.array(asked))
    for row, text in zip(bits, asked, strict=True):
        assert row == pytest.approx([brute_bits(known[lang], language.ORDER, text or "") for lang in trees.langs], rel=1e-5)
    before, language.SLICE = language.SLICE, 5
    try:
        assert language.code_lengths(trees, pa.array(asked)) == pytest.approx(bits, rel=1e-5)
    finally:
        language.SLICE = before


def test_language_learns_from_all_documents(spark, monkeypatch):
    """More documents than any sample had, counted in slices that cut texts."""
    rows = [(i, f"aa{i:04d} bé" if i % 2 else "xyz" * (i % 5), "p" if i % 2 else "q") for i in range(3000)] + [(1, None, "p"), (2, "lost", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    monkeypatch.setattr(language, "COUNTED", 7)
    held = {r.doc_id for r in docs.filter(language.held_out(docs["doc_id"])).collect()}
    known = [(lang, text) for i, text, lang in rows if i not in held and text and lang]
    assert len(known) > 1600
    want = {}
    for lang, text in known:
        raw = text.encode()
        for at in range(len(raw)):
            gram = int.from_bytes(raw[max(0, at - language.ORDER) : at + 1], "big")
            want[lang, gram] = want.get((lang, gram), 0) + 1
    counted = language.labelled(docs).mapInArrow(language._count, "lang string, gram long, n long").groupBy("lang", "gram").sum("n")
    assert {(r[0], r[1]): r[2] for r in counted.collect()} == want


def test_language_held_out(spark, sf_dir, docs, empty):
    found = language.identify(spark.read.parquet(f"{sf_dir}/documents.parquet")).toPandas()
    own = found[found.held_out]
    assert (own.lang == own.lang_pred).mean() > 0.9
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(found.doc_id, found.held_out, strict=True))
    odd = {(r.doc_id, r.lang_pred, r.score) for r in language.identify(docs).collect()}
    assert {(0, "und", 0.0), (1, "und", 0.0), (2, "und", 0.0)} <= odd
    assert language.identify(empty).count() == 0


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    got = defaultdict(list)
    for r in token_counts.tokens_by_line(docs.filter("doc_id <> 8").select("doc_id", "text", "n_chars")).collect():
        got[r.doc_id].append((r.section, r.n_tokens, r.n_chars))
    for i, text in texts():
        if i is None or i == 8 or len(text or "") > 5_500:
            continue
        text = text or ""
        counts = Counter(text[:a].count("\n") for a, _ in reference.encode(text, add_special_tokens=False).offsets)
        lines = text.split("\n")
        lines = lines[:-1] if len(lines) > 1 and not lines[-1] else lines
        assert sorted(got[i]) == [(k, counts[k], len(x) + (text != x and (k < len(lines) - 1 or text.endswith("\n")))) for k, x in enumerate(lines)], i
    assert token_counts.tokens_by_line(empty).count() == 0


def test_token_rules():
    first, last, starts = np.array([0, 2, 5, 9]), np.array([1, 4, 8, 9]), np.array([0, 3, 6])
    assert list(token_counts.allocate(first, last, starts, "first")) == [2, 1, 1]
    assert list(token_counts.allocate(first, last, starts, "most")) == [1, 1, 2]
    assert list(token_counts.allocate(first, last, starts, "each")) == [2, 2, 2]
    encoder = token_counts.Encoder(token_counts.read_ranks())
    text = "word" + " " * 7_000 + "word"
    assert encoder.encoding.decode(encoder.ids(text)) == text


def test_token_fields(spark):
    rows = spark.createDataFrame([(1, "a b", None, "c"), (2, None, None, None)], "doc_id long, x string, y string, z string")
    got = sorted(map(tuple, token_counts.tokens_by_field(rows, ["x", "y", "z"]).collect()))
    assert [g[:2] for g in got] == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2)]
    assert [g[3] for g in got] == [3, 0, 1, 0, 0, 0]


@pytest.mark.parametrize("shards", [24, 5])
def test_shards(docs, empty, shards):
    got = sharding.balanced_shards(docs, shards).toPandas()
    assert len(got) == len(texts())
    counts = got.groupby("shard").slot.agg(["count", "max"]).reindex(range(shards), fill_value=0)
    assert counts["count"].max() - counts["count"].min() <= 1
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    want = Counter((i if i is not None else -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts())
    assert Counter(zip(got.doc_id.fillna(-1).astype(int), got["size"], got.text_crc32, strict=True)) == want
    assert sharding.balanced_shards(empty, shards).count() == 0


def test_shards_keep_texts_together(spark):
    rows = [(i, f"text {i // 3}") for i in range(600)] + [(1000 + i, "hot") for i in range(300)]
    got = sharding.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string"), 6).toPandas().merge(
        __import__("pandas").DataFrame(rows, columns=["doc_id", "text"]), on="doc_id"
    )
    cut = got.groupby("text").shard.nunique()
    assert (cut > 1).sum() <= 6
    assert cut["hot"] <= 4


def test_topk(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16)]) for i in range(400)]
    rows += [(400 + i, rows[40][1]) for i in range(30)] + [(500, None), (501, [float("nan")] * 16), (502, [None] * 16), (520, [1.0, 2.0]), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    got = sorted(map(tuple, topk.top_k(df).collect()))
    good = {i: np.floor(64 * np.array(v)).astype(int) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q, v in good.items():
        if q % 20 == 0:
            scored = sorted((-int(v @ w), i) for i, w in good.items() if i != q and len(w) == len(v))[:20]
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    assert got == sorted(want)
    assert topk.top_k(df.limit(0)).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_leaks(text, items):
    split = lambda t: WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item, t in items:
        w = split(t)
        n = min(10, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(words), len(hit), sorted(x for x in found if x is not None)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 60])
def test_decontaminate(spark, docs, empty, block):
    longest = texts()[-5][1]
    rows = [(1, "ONE"), (2, " ".join(WORD.findall(longest)[3:25])), (10, longest[:80]), (10, longest[:80]), (None, "theta eta"), (5, None), (6, "..")]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.find_leaks(docs, benchmark, block_bytes=block).collect())
    items = [(None if i is None else str(i), t) for i, t in rows]
    want = Counter((i, n, hit, tuple(found)) for i, t in texts() for n, hit, found in [brute_leaks(t, items)])
    assert got == want
    assert decontaminate.find_leaks(empty, benchmark).count() == 0
    assert decontaminate.find_leaks(docs, benchmark.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.remove_leaks(docs, benchmark).columns == docs.columns


def test_words_in_slices():
    text = "Ab cd éf, gh 12 " * 20
    whole = decontaminate.Words(np.frombuffer(text.encode(), np.uint8)).hash
    before, decontaminate.SLICE = decontaminate.SLICE, 16
    try:
        assert (decontaminate.Words(np.frombuffer(text.encode(), np.uint8)).hash == whole).all()
    finally:
        decontaminate.SLICE = before


def test_permutation():
    for size in (1, 2, 7, 100, 1000):
        image = [pii.permute(x, size, b"k", "t") for x in range(size)]
        assert sorted(image) == list(range(size))
        assert [pii.permute(x, size, b"k", "t", back=True) for x in image] == list(range(size))


def test_pii(spark, docs, empty):
    values = {
        "card": "4111 1111 1111 1111", "phone": "+1 (375) 555-4393", "day": "1984-02-29", "social": "123-45-6789", "account": "GB82 WEST 1234 5698 7654 32",
        "address": "54.158.173.199", "email": "jo.doe7@mail.example.com", "international": "+44 20 7946 0958", "secret": "password=6190852a02e4c4b9a4",
    }
    rows = [(1, f"a {v} b") for v in values.values()] + [(2, f"c {v}.") for v in values.values()] + [(3, None), (4, ""), (5, "4111111111111112 1984-02-30 999.1.1.1 000-12-3456")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in pii.pseudonymise(df, b"key").collect()]
    for k, (kind, value) in enumerate(values.items()):
        (_, one, kinds), (_, two, _) = got[k], got[k + len(values)]
        assert kinds == [kind] and value not in one
        assert one.removeprefix("a ").removesuffix(" b") == two.removeprefix("c ").removesuffix(".")
        assert kind in ("address", "account") or re.sub("[0-9a-z]", "x", one) == re.sub("[0-9a-z]", "x", f"a {value} b")
    assert pii.luhn(re.sub(" ", "", got[0][1][2:-2])) == 0
    assert got[-3:] == [(3, None, []), (4, "", []), (5, rows[-1][1], [])]
    back = pii.pseudonymise(pii.pseudonymise(df, b"key").select("doc_id", "text"), b"key", back=True)
    assert [r.text for r in back.collect()] == [t for _, t in rows]
    assert pii.pseudonymise(docs, b"key").count() == len(texts())
    assert pii.pseudonymise(empty, b"key").count() == 0


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    prints = [brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return Counter((doc, prints[i], least.get(find(i))) for i, (doc, _) in enumerate(rows))


def test_simhash(docs, empty):
    got = Counter((r.doc_id, r.print & 0xFFFFFFFFFFFFFFFF, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == brute_classes(texts())
    assert simhash.near_duplicates(empty).count() == 0
    kept = [r.doc_id for r in simhash.one_of_each(docs).collect()]
    assert sorted(x for x in kept if x is not None) == sorted({c for (_, _, c) in got if c is not None})


@pytest.mark.parametrize("crowded", [simhash.CROWDED, 3])
def test_close_links(spark, crowded):
    rng = random.Random(9)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:60]:
        for _ in range(6):
            p ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.close_links(spark.createDataFrame([(p,) for p in signed], "print long"), crowded=crowded)
    roots = dict(map(tuple, components.connected_components(links).collect()))
    all_ = sorted(signed)
    want = {}
    for p in all_:
        if p in want:
            continue
        todo, group = [p], {p}
        while todo:
            x = todo.pop()
            for y in all_:
                if y not in group and ((x ^ y) & 0xFFFFFFFFFFFFFFFF).bit_count() <= 4:
                    group.add(y)
                    todo.append(y)
        want |= {x: min(group) for x in group}
    assert {p: roots.get(p, p) for p in all_} == want


def best_sum(v, chars):
    """Largest sum of scores by trying every piece at every place."""
    best = [0.0] + [-np.inf] * len(chars)
    for j in range(1, len(chars) + 1):
        for i in range(max(0, j - v.longest), j):
            gain = v.scores.get(chars[i:j], v.unknown if j == i + 1 else None)
            if gain is not None:
                best[j] = max(best[j], best[i] + gain)
    return best[-1]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def total(v, ids):
    by_id = {i: v.scores[p] for p, i in v.ids.items()}
    return sum(by_id[i] for i in ids)


def test_viterbi(vocabulary):
    encoder, rng = pieces.Encoder(vocabulary), random.Random(3)
    for _ in range(60):
        unit = pieces.MARK + "".join(rng.choice("abcdethinrs") for _ in range(rng.randint(1, 30)))
        ids = [i for part in encoder.viterbi(unit) for i in part]
        assert total(vocabulary, ids) == pytest.approx(best_sum(vocabulary, unit))
        assert encoder.arrays.encode([unit]) == {unit: pack(f"<{len(ids)}i", *ids)}
    long = pieces.MARK + "".join(rng.choice("abcdethinrs") for _ in range(3_000))
    parts = list(encoder.viterbi(long))
    assert len(parts) > 5 and encoder.most_held <= 40 * vocabulary.longest
    assert total(vocabulary, [i for p in parts for i in p]) == pytest.approx(best_sum(vocabulary, long))


def test_small_vocabulary():
    scores = {"a": -1.0, "ab": -1.5, "b": -1.0, "ba": -1.6, "a▁b": -0.5, "▁": -1.0}
    ids = {p: 256 + i for i, p in enumerate(scores)}
    v = pieces.make(scores, ids, [bytes([i]) for i in range(256)] + [p.replace("▁", " ").encode() for p in scores], list(range(256)))
    encoder = pieces.Encoder(v)
    for text in ("ab", "a b", "abab ba", "x", "a\nb", "▁a", " ", "  a  b"):
        (raw,) = encoder.encode([text])
        assert pieces.decode(v.texts, np.frombuffer(raw, "<i4")) == text


def test_stretches_and_whole_texts_give_the_same_ids(vocabulary, spark, sf_dir):
    """Cutting at certain boundaries and searching in arrays changes no id of the streaming search over a whole text."""
    own = [t or "" for _, t in texts() if len(t or "") < 6_000]
    own += [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 40").select("text").collect()]
    encoder = pieces.Encoder(vocabulary)
    for text, raw in zip(own, encoder.encode(own), strict=True):
        marked = pieces.MARK + text.replace(pieces.MARK, pieces.OWN).replace(" ", pieces.MARK)
        ids = [i for part in encoder.viterbi(marked) for i in part] if text else []
        assert np.frombuffer(raw, "<i4").tolist() == ids


def test_round_trip(docs, empty):
    got = Counter((r.doc_id, r.decoded) for r in pieces.round_trip(docs).collect())
    assert got == Counter((i, t or "") for i, t in texts())
    assert pieces.round_trip(empty).count() == 0


def brute_pipeline(rows, understood, items):
    """Texts that stay, by id, of (doc_id, text) rows."""
    now = [(i, t) for i, t in rows if i in understood]
    now = [(i, kept) for i, _, dropped, kept in brute_lines(now) if not (dropped and not kept.strip(" "))]
    chosen = {c for (_, _, c) in brute_classes(now)}
    return {i: t for i, t in now if i in chosen and not brute_leaks(t, items)[1]}


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    from corpusloom.fixtures import table

    docs = table(spark, sf_dir, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    items = [(str(r.item_id), r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    understood = {r.doc_id for r in language.understood(docs).collect()}
    # All of these tables are in learned languages, junk and secrets among them.
    assert understood == {i for i, t in rows if re.search("[^\\W\\d_]", t or "")}
    want = brute_pipeline(rows, understood, items)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: r.text for r in got} == want and len(got) == len(want)
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = stage(spark, before, sf_dir)
        assert before.dtypes == docs.dtypes
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf_dir).count() == 0


def test_what_is_no_language_goes(spark, sf_dir):
    rng = random.Random(6)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(10_001, "".join(rng.choice("qxzjkvwpbgfy0123456789") for _ in range(400)), None), (10_002, "Это другой язык, которого никто не учил. " * 8, None)]
    odd += [(10_003, None, "en"), (10_004, "", "en"), (10_005, "123 456", None), (10_006, "日本語の文章がここにあります。" * 5, None), (None, "the and of to in is that it was for on with", None)]
    mixed = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    mixed = mixed.selectExpr("*", "'mine' AS lang_pred", "7 AS score", "8 AS bits", "9 AS row", "10 AS best", "11 AS held_out")
    kept = language.understood(mixed)
    assert kept.columns == mixed.columns
    rows = kept.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()} | {None}
    assert all((r.lang_pred, r.score, r.row) == ("mine", 7, 9) for r in rows)
    assert language.understood(docs.limit(0)).count() == 0
    assert language.understood(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).count() == 0


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Nulls, repeated ids and rows, odd texts and columns named like the stages' own."""
    import corpus_pipeline

    rng = random.Random(2)
    words = ["the", "house", "stands", "near", "river", "and", "old", "people", "walk", "there", "every", "morning", "with", "dogs", "green", "trees", "grow"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    leak = "one two three four five six seven eight nine ten eleven"
    rows = [(i, prose(rng.randint(20, 80)), "en") for i in range(60)]
    base = prose(6_000)  # copies of it differ in their last word
    rows += [(100 + i, f"{base} end{i}", "en") for i in range(5)] + [(100, f"{base} end0", "en"), (101, prose(50), None), (None, prose(40), None), (None, prose(40), None)]
    rows += [(200, None, None), (201, "", "en"), (202, " \n\t", None), (203, prose(30) + " " + leak + " " + prose(9), "en"), (204, prose(12_000), "en")]
    shared = "this very line stands in many of the documents"
    rows += [(300 + i, shared + "\n" + prose(50), "en") for i in range(4)]
    schema = "doc_id long, text string, lang string"
    names = ["source", "n_words", "first", "length", "items", "n_hit", "row", "print", "_print", "lang_pred", "score", "keep", "gone", "id", "ids", "key", "best", "new", "component_id"]
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "cast(length(text) as bigint) AS n_chars", *[f"{i} AS {n}" for i, n in enumerate(names)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("b1", leak), (None, None)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.dtypes == docs.dtypes, name
        kept[name] = [(r.doc_id, r.text) for r in now.collect()]
        assert all(r.source == 0 and r.component_id == len(names) - 1 for r in now.collect())
    ids = {name: [i for i, _ in found] for name, found in kept.items()}
    assert not {200, 201, 202} & set(ids["language_id"]) and ids["language_id"].count(None) == 2 and ids["language_id"].count(100) == 2
    assert [t.count(shared) for i, t in sorted((i, t) for i, t in kept["line_dedup"] if i in range(300, 304))] == [0, 0, 0, 1]
    assert sorted(i for i in ids["near_duplicates"] if i in range(100, 105)) == [100, 101] and ids["near_duplicates"].count(None) == 2
    assert 203 in ids["near_duplicates"] and 203 not in ids["decontamination"]
    assert set(range(60)) <= set(ids["decontamination"]) and 204 in ids["decontamination"]
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((str(r.doc_id), r.text) for r in done.collect()) == sorted((str(i), t) for i, t in kept["decontamination"])
