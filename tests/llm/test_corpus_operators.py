"""Mixing, packing, secrets, near duplicates, fingerprints: against plain versions and on odd rows."""

import collections
import hashlib
import random
import re
import string
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from safetylake.llm import components, mixing, near_dup, packing, secret_scan, spotsigs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# --- mixing ----------------------------------------------------------------------------------------


def test_mix_meets_its_targets(small):
    rows = mixing.op1_mixing(small).collect()
    of = {r.doc_id: r.source for r in small.collect()}
    taken, target = collections.Counter(), {}
    for r in rows:
        taken[of[r.doc_id]] += r.taken
        target[of[r.doc_id]] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(r.size for r in rows)) < 1e-3
    assert sorted(rows) == sorted(mixing.op1_mixing(small.repartition(5)).collect())


def test_mix_on_odd_rows(odd, none):
    rows = mixing.op1_mixing(odd).collect()
    assert len(rows) == odd.count()
    assert mixing.op1_mixing(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    by_source = {(r.source_size, round(r.target, 6)) for r in rows}
    assert len(by_source) >= 3
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert sum(len(WORDS.findall(r.text or "")) for r in mixed.collect()) == sum(r.taken for r in rows)


# --- packing ---------------------------------------------------------------------------------------


def unpacked(rows):
    """Token ids by window and by document; checks that windows have no gaps."""
    windows, docs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append(r)
        docs[r.doc_id].append(r)
    for parts in windows.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW
    return windows, docs


def test_packing_round_trip(small):
    rows = packing.pack(small).collect()
    windows, docs = unpacked(rows)
    exact = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    for r in small.collect():
        parts = sorted(docs[r.doc_id], key=lambda p: p.start)
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in parts]).tolist()
        assert ids == [*exact.encode(r.text or "", add_special_tokens=False).ids, 0]
        assert [p.start for p in parts] == np.cumsum([0, *[p.length for p in parts]])[:-1].tolist()
        assert {p.doc_tokens for p in parts} == {len(ids)}
    total = sum(r.length for r in rows)
    assert len(windows) * packing.WINDOW <= total * 1.02 + 8 * packing.WINDOW
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in packing.op3_packing(small).collect()}
    assert digest == {(r.doc_id, r.start): zlib.crc32(r.ids) for r in rows}


def test_packing_odd_rows(odd, none):
    rows = packing.pack(odd).collect()
    unpacked(rows)
    assert sum(r.start == 0 for r in rows) == odd.count()
    assert packing.op3_packing(none).count() == 0


def test_encoder_equals_the_library():
    path = public_tokenizers.path(packing.VOCABULARY)
    exact = Tokenizer.from_file(path)
    fast = packing.encoder(path)
    rng = random.Random(3)
    texts = ["", " ", "<|endoftext|>", "a b", "\U0001f600 ́x", "x" * 5000, " " * 5000, "It's 12,345 don't\r\n\t"]
    texts += ["".join(rng.choices("ab 'stn\n\té中1!\U0001f600", k=40)) for _ in range(300)]
    for text in texts:
        assert fast(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_differencing_is_near_equal():
    rng = random.Random(1)
    sizes = [rng.randint(1, 256) for _ in range(500)]
    windows = packing.deal(sizes, 1024)
    assert sorted(i for w in windows for i in w) == list(range(500))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) <= 1024 and max(sums) - min(sums) < 32
    assert packing.deal([1024, 1024, 1], 1024) and packing.deal([], 1024) == []


# --- secrets ---------------------------------------------------------------------------------------


def plain_base(text):
    out = []
    keyword = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out += [("assign", *m.span()) for m in keyword.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(5)
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "=", ": ", '"', "'", "abcdef0123456789" * 2, "short", "AKIA", "ABCDEFGH12345678", " ", "ſecret=abcdefgh1", "\n"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=12))
        assert sorted(secret_scan.base_spans(text), key=lambda s: (s[1], secret_scan.KINDS.index(s[0]))) == plain_base(text)


def test_battery_tells_keys_from_words():
    rng = random.Random(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choices(letters, k=40)) for _ in range(100)]
    assert sum(p < 1e-3 and even >= secret_scan.FLOOR for p, even in map(secret_scan.battery, keys)) >= 95
    for words in ["internationalisation", "some-long-title-of-an-article-2024", "src/main/java/org/apache", "A" * 40, "CamelCaseIdentifierForThings", "12345678901234567890"]:
        p, even = secret_scan.battery(words)
        assert p > 0.05 or even < secret_scan.FLOOR


def test_added_spans_and_redaction(spark):
    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = [(i, f"the words and {''.join(rng.choices(letters, k=48))} between them", "en", "s", 0) for i in range(30)]
    rows += [(100 + i, "an extraordinarilylongcompoundwordhere and a common-hyphenated-string-of-words", "en", "s", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r for r in secret_scan.op4_secret_scan(docs).collect()}
    assert sum("random:14:62" in found[i].spans for i in range(30)) >= 28
    assert all(found[100 + i].spans == "" for i in range(30))
    assert found[100].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r for r in secret_scan.redacted(docs).collect()}
    assert clean[0].text == "the words and [SECRET] between them" and clean[0].n_chars == len(clean[0].text)


def test_values_after_names_and_runs_over_base_spans(spark):
    rng = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows, want = [], {}
    for i in range(30):
        key, access = "".join(rng.choices(letters, k=48)), "AKIA" + "".join(rng.choices(letters[:26], k=16))
        for n, (head, secret, tail) in enumerate([("a session=", key, " b"), ("get /x?sig=", key, "&y=1"), ("AccountKey=", f"{key[:46]}==", " ."), ("see ", f"{access}/{key[:40]}", "")]):
            rows.append((10 * i + n, head + secret + tail, "en", "s", 0))
            want[10 * i + n] = (f"random:{len(head)}:{len(head) + len(secret)}", f"{head}[SECRET]{tail}")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spans = {r.doc_id: r.spans.split(",") for r in secret_scan.op4_secret_scan(docs).collect()}
    clean = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    for n in range(4):
        assert sum(want[10 * i + n][0] in spans[10 * i + n] and clean[10 * i + n] == want[10 * i + n][1] for i in range(30)) >= 27
    assert all(any(s.startswith("access:4:") for s in spans[10 * i + 3]) for i in range(30))
    inside = "".join(rng.choices(letters, k=48))
    assert secret_scan.spans_of(f"token={inside}", {0: 0, 1: 0, 2: 0})[1] == [("assign", 0, 54)]


def test_secrets_against_plain_version(small, odd, none):
    for docs in (small, odd):
        found = secret_scan.op4_secret_scan(docs).collect()
        texts = collections.defaultdict(list)
        for r in docs.collect():
            texts[r.doc_id].append(r.text or "")
        assert len(found) == docs.count()
        for r in found:
            plain = [plain_base(t) for t in texts[r.doc_id]]
            assert r.base_sha256 in {hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in p).encode()).hexdigest() for p in plain}
    assert secret_scan.op4_secret_scan(none).count() == 0
    redacted = secret_scan.redacted(odd)
    assert redacted.columns == odd.columns and redacted.count() == odd.count()
    assert [r.text for r in redacted.where("doc_id = 12").collect()] == ["[SECRET]' and more\nyou stupid idiot!!"]


# --- near duplicates -------------------------------------------------------------------------------


def plain_groups(docs, width, percent=80):
    """{row: (set size, smallest id reachable)} by comparing all sets that share a shingle."""
    lower = {i: chr(i + 32) for i in range(65, 91)}
    sets = []
    for _, text in docs:
        w = WORDS.findall((text or "").translate(lower))
        sets.append(frozenset(tuple(w[j : j + width]) for j in range(max(1, len(w) - width + 1))) if w else frozenset())
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and root(i) != root(j) and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(doc_id, len(sets[i]), least.get(root(i))) for i, (doc_id, _) in enumerate(docs)]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_all_pairs(small, odd, width):
    for docs in (small, odd):
        rows = near_dup.near_duplicates(docs, words=width).collect()
        plain = plain_groups([(r.doc_id, r.text) for r in docs.collect()], width)
        assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == collections.Counter(plain)
        assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.component_id is not None)


def test_large_groups_of_copies_stay_linear(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(900):
        words = list(base)
        for _ in range(rng.randrange(8)):
            words[rng.randrange(len(words))] = f"n{i}x{rng.randrange(99)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"z{rng.randrange(4000)}" for _ in range(60))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dup.near_duplicates(docs, words=2).collect()
    plain = plain_groups(rows, 2)
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == collections.Counter(plain)
    assert near_dup.deduplicated(docs.selectExpr("*", "1 n_chars"), words=2).count() == sum(a == c for a, _, c in plain)


def keyed(text, width=2):
    return near_dup.key_of(near_dup.class_of(near_dup.shingles(text, width)))


def star_of(rng, copies):
    """(key, text) of an original, and texts that are like it but not like each other."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    out = []
    for i in range(copies):
        text = list(words)
        for n, at in enumerate(rng.sample(range(0, 200, 2), 9)):
            text[at] = f"n{i}x{n}"
        out.append(" ".join(text))
    return keyed(" ".join(words)), " ".join(words), out


def star(rng, copies):
    """star_of() with keyed copies, where the original sorts late."""
    while True:
        key, text, out = star_of(rng, copies)
        keys = {keyed(t): t for t in out}
        if sum(k < key for k in keys) > 2 * near_dup.TOGETHER:
            return key, text, keys


def test_copies_of_one_original_are_one_group(spark):
    original, text, copies = star(random.Random(12), 3000)
    a, b = (near_dup.shingles(t, 2) for t in list(copies.values())[:2])
    whole = near_dup.shingles(text, 2)
    like = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert like(a, whole) >= 0.8 > like(a, b)
    rows = [(1, key, t) for key, t in [*copies.items(), (original, text)]]
    links = near_dup._confirmed_links(spark.createDataFrame(rows, "place long, key long, text string"), 2, 80).collect()
    union = near_dup.Union()
    assert all(union.join(r.u, r.v) for r in links) and len(links) == 3000


def test_large_places_are_settled_in_bounded_units(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK", 60)
    monkeypatch.setattr(near_dup, "TOGETHER", 20)
    rng = random.Random(13)
    sets, rows = [], []
    for _ in range(6):
        _, text, copies = star_of(rng, 40)
        sets += [text, *copies]
    near = [f"v{i}" for i in range(200)]
    for i in range(300):  # a large component, and rows unlike all others
        sets.append(" ".join([*near[:195], *(f"m{i}x{k}" for k in range(5))]))
    sets += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(90)) for _ in range(100)]
    rows = [(1, keyed(t), t) for t in sets]
    docs = spark.createDataFrame(rows, "place long, key long, text string")
    links = near_dup._confirmed_links(docs, 2, 80).collect()
    union = near_dup.Union()
    for r in links:
        union.join(r.u, r.v)
    plain = plain_groups([(key, text) for _, key, text in rows], 2)
    groups = collections.defaultdict(set)
    for key, _, least in plain:
        groups[least].add(union.root(key))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)
    held = near_dup.Settling(80, near_dup.TOGETHER, (near_dup.CHUNK, near_dup.CHUNK_SIZE))
    for _, key, text in sorted(rows):
        held.add(key, near_dup.shingles(text, 2))
        assert len(held.rows) <= near_dup.CHUNK
    assert len(held.rest) == len(rows) - near_dup.TOGETHER


def test_one_row_of_each_group_is_kept(spark):
    texts = {c: [f"{c}{i}" for i in range(60)] for c in "abcde"}
    near = lambda c, k: " ".join([*texts[c], *(f"{c}x{k}",) * (k > 0)])
    rows = [(0, near("b", 0)), (1, near("a", 0)), (1, near("b", 1)), (5, near("c", 0)), (None, near("c", 1))]
    rows += [(None, near("d", k)) for k in range(3)] + [(None, ""), (9, None), (7, near("e", 0)), (7, near("e", 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, (r.text or "-")[0]) for r in near_dup.deduplicated(docs, words=2).collect()]
    assert sorted(kept, key=str) == sorted([(0, "b"), (1, "a"), (5, "c"), (None, "d"), (None, "-"), (9, "-"), (7, "e")], key=str)


@pytest.mark.parametrize("rows", [500, 100_000, 10_000_000])
def test_trees_and_sketches_reach_the_recall(rows):
    depth, trees = near_dup.forest_size(rows)
    rng = np.random.default_rng(14)
    equal = rng.binomial(near_dup.COORDINATES, 0.8, 200_000) / near_dup.COORDINATES  # coordinates a pair shares
    met = {k: 1 - (1 - near_dup.meeting(depth, k)) ** trees for k in np.unique(equal).tolist()}
    bytes_ = rng.binomial(near_dup.SKETCH, 0.8 + 0.2 / 256, 200_000)
    assert np.mean([met[k] for k in equal.tolist()]) - np.mean(bytes_ < near_dup.ALIKE) >= near_dup.RECALL - 5e-5


def test_near_duplicates_of_nothing(none):
    assert near_dup.op9_near_dup(none).count() == 0
    assert near_dup.deduplicated(none).columns == none.columns


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    found = {r.u: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {x: root(x) for x in nodes}


# --- fingerprints ----------------------------------------------------------------------------------


def test_fingerprints(small):
    rows = {r.doc_id: r for r in spotsigs.op5_spotsigs(small).collect()}
    docs = sorted((r.doc_id, r.text or "") for r in small.collect())
    prints = collections.defaultdict(set)
    for at, (doc_id, text) in enumerate(docs):
        after = docs[(at + 1) % len(docs)][1]
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        r = rows[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = (set(re.findall("." * 8, x)) for x in (r.fingerprint, r.edited_fingerprint))
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        prints[text].add(r.fingerprint)
    assert all(len(x) == 1 for x in prints.values())
    assert sum(r.near_edited > r.near_next for r in rows.values()) >= 0.97 * len(rows)


def test_fingerprints_on_odd_rows(odd, none, spark):
    rows = spotsigs.op5_spotsigs(odd).collect()
    assert len(rows) == odd.count()
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {""}
    assert spotsigs.op5_spotsigs(none).count() == 0
    alone = spotsigs.op5_spotsigs(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1.0


def test_one_rule_for_fingerprints_of_any_length(spark):
    text = "the red house of old brick the green door of"
    rows = [(i, text + " new paint the high wall of cold stone the low roof" * i) for i in range(3)]
    found = [r.fingerprint for r in spotsigs.op5_spotsigs(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()]
    sets = [set(re.findall("." * 8, f)) for f in found]
    assert all(sets) and sets[0] < sets[1] <= sets[2]  # a longer text only adds signatures


def test_signatures_equal_a_plain_version(spark, small):
    """A signature starts at a content word that a common word stands before, and takes the next content word."""

    def plain(text):
        words = re.sub(r"[^\w]+|_", " ", text.lower()).split()
        common = [len(w) <= 3 or w in spotsigs.COMMON for w in words]
        content = [i for i, c in enumerate(common) if not c]
        return {(words[i - 1], words[i], words[j]) for i, j in zip(content, content[1:], strict=False) if i and common[i - 1]}

    rows = [(r.doc_id, r.text) for r in small.collect() if r.text and r.text.isascii()][:80]
    made = spotsigs.with_signatures(spark.createDataFrame(rows, "doc_id long, text string"), "text", "sets").collect()
    assert len(made) > 20
    for r in made:
        expected = plain(r.text)
        assert len(r.sets) == len(expected) or (not expected and len(r.sets) <= 1)


def test_pairs_of_fingerprints_equal_all_pairs(small):
    rows = spotsigs.op5_spotsigs(small).collect()
    sets = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        if r.fingerprint:
            sets.setdefault(frozenset(re.findall("." * 8, r.fingerprint)), r.doc_id)
    items = sorted((i, s) for s, i in sets.items())
    plain = {(i, j) for a, (i, s) in enumerate(items) for j, t in items[a + 1 :] if len(s & t) / len(s | t) >= 0.5}
    found = {(r.a, r.b) for r in spotsigs.near_pairs(small, 0.5).collect()}
    assert found == plain


def test_secret_scan_takes_time_in_proportion_to_the_text():
    rng = random.Random(9)
    token = lambda n: "".join(rng.choices(string.ascii_letters + string.digits, k=n))
    seconds = []
    for n in (2000, 16000):
        text = " ".join(f"token={token(30)} {token(20)}" for _ in range(n))
        start = time.perf_counter()
        base, spans = secret_scan.spans_of(text, {0: 10, 1: 10, 2: 10})
        seconds.append(time.perf_counter() - start)
        assert len(base) == n and len(spans) > n
    assert seconds[1] < 8 * 4 * seconds[0]
