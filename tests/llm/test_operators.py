"""The ten operators against brute force, on small tables with nulls, ties, empty and long texts."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as registered
from hearthlake.llm import byte_bpe, exact_dedup, main_text, mixing, passages, quality_rules, range_coder, shards, simhash, token_store, url_filter
from hearthlake.llm.components import components
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, shard int"
RANDOM = random.Random(4)
LONG = " ".join(RANDOM.choice(["alpha", "beta", "Gamma", "delta,", "É", "日本"]) + str(RANDOM.randrange(400)) for _ in range(3000))
TEXTS = [None, "", " \n\t", "a", "A b", "a B", LONG, LONG.upper(), LONG + " tail", "x  y\n\nz  ", "dup\ndup\ndup one two three\n" * 30, "it's #1 <b> & *", "é É", "=" * 700, "<|endoftext|>"]


def docs(spark, texts=TEXTS, sources=("s", None, "")):
    """Rows with clashing extra columns; a third of all rows share one text."""
    rows = [(i, t) for i, t in enumerate(list(texts) + ["hot Text"] * (len(texts) // 2))]
    return spark.createDataFrame([(i, t, "en", sources[i % len(sources)], None, "clash", 7) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def table(spark):
    return docs(spark).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["op3_quality_cascade", "op7_curriculum_mix", "op8_exact_dedup"])
def test_agrees_with_oracle(spark, name):
    assert differences(spark, connect(SF_DIR), name, SF_DIR) == []


def test_empty_tables(spark, nothing, tmp_path):
    found = [
        exact_dedup.exact_duplicates(nothing), shards.interleaved(nothing), mixing.mixed(nothing), quality_rules.judged(nothing),
        simhash.near_duplicates(nothing), byte_bpe.round_trip(nothing), passages.passage_links(nothing), mixing.curriculum(nothing),
        quality_rules.passing(nothing), exact_dedup.without_copies(nothing), simhash.without_near_copies(nothing),
    ]
    assert [f.count() for f in found] == [0] * len(found)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert main_text.extracted(pages).count() == 0
    assert url_filter.judged(pages, spark.createDataFrame([], "page_id long, bad int")).count() == 0


@pytest.mark.parametrize("digest", [exact_dedup.sha256_digest, lambda t: F.substring(F.sha2(t, 256), 1, 1)])
def test_exact_duplicates(table, digest):
    """Also with a digest that many texts share."""
    rows = [(r.doc_id, re.sub("[A-Z]+", lambda m: m[0].lower(), r.text or "")) for r in table.collect()]
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text].append(doc)
    wanted = {(d, max(groups[t]), len(groups[t]), d == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for d, t in rows}
    assert {tuple(r) for r in exact_dedup.exact_duplicates(table, digest=digest).collect()} == wanted
    kept = exact_dedup.without_copies(table.unionByName(table))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, *_, k, _ in wanted if k)
    assert kept.columns == table.columns


@pytest.mark.parametrize("per_bucket", [4, 20_000])
def test_interleaved(table, per_bucket):
    found = shards.interleaved(table, shards=4, rows_per_bucket=per_bucket).collect()
    count = table.count()
    sizes = Counter(r.shard for r in found)
    assert len(found) == count and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(n)) for s, n in sizes.items())
    for source, n in Counter(r.source for r in found).items():
        assert all(abs(sum(r.shard == s and r.source == source for r in found) - n / 4) <= 2 for s in sizes)
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in found)
    again = shards.interleaved(table.repartition(5), shards=4).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in found} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_mixed(table):
    found = mixing.mixed(table, rows_per_bucket=4).collect()
    texts = {r.doc_id: (r.source, len(WORDS.findall(r.text or ""))) for r in table.collect()}
    sizes = Counter()
    for source, n in texts.values():
        sizes[source] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights, open_, wanted = dict(zip(order, (5, 2, 1))), set(order), {}
    rest = 1.5 * sum(sizes.values())
    while True:  # round after round, as the contract says
        share = {s: rest * weights[s] / sum(weights[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not above:
            wanted |= share
            break
        for s in above:
            wanted[s] = 2.0 * sizes[s]
            rest -= wanted[s]
        open_ -= above
    largest = max(n for _, n in texts.values())
    for source in order:
        own = [r for r in found if texts[r.doc_id][0] == source]
        assert all(abs(r.target - wanted[source]) < 1e-6 and r.size == texts[r.doc_id][1] and r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - wanted[source]) <= largest / 2 + 1
        times = [t for r in own for t in (r.first_position, r.second_position) if t is not None]
        assert all(0 <= t <= 1 for t in times)
    copies = Counter(r.doc_id for r in mixing.curriculum(table).collect())
    assert copies == Counter({r.doc_id: n for r in found if (n := sum(t is not None for t in (r.first_position, r.second_position)))})


def test_mix_is_read_from_its_range_sorted_order(spark, monkeypatch):
    """The query's rows come from the mix in training order, whose partitions ascend by position."""
    orders, sequence = [], mixing.sequence
    monkeypatch.setattr(mixing, "sequence", lambda *args, **named: orders.append(sequence(*args, **named)) or orders[-1])
    rows = mixing.op7_curriculum_mix(spark, SF_DIR)
    assert len(orders) == 1 and "rangepartitioning(position" in orders[0]._jdf.queryExecution().executedPlan().toString()
    positions = [r.position for r in orders[0].collect()]
    assert len(positions) > 100 and positions == sorted(positions)
    wanted = mixing.mixed(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()
    found = rows.collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, wanted))
    assert sorted(positions) == sorted(p for r in found for p in (r.first_position, r.second_position) if p is not None)


def test_curriculum_of_shared_ids(spark):
    """Rows that share a doc_id, or have none: those go out that the targets take."""
    rng = random.Random(7)
    rows = [(i if i % 3 else (None if i % 2 else 5), " ".join(["w"] * (i + 1)), rng.choice("abc")) for i in range(90)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    target = {(r.doc_id, r.size): r.target for r in mixing.mixed(table).collect()}
    wanted = Counter()
    for source in "abc":
        key = lambda r: (hashlib.md5(f"11/{'' if r[0] is None else r[0]}".encode()).hexdigest(), len(r[1].split()))
        own = sorted((r for r in rows if r[2] == source), key=key)
        start, total = 0, sum(len(r[1].split()) for r in own)
        for r in own:
            size = len(r[1].split())
            wanted[r] += sum(2 * (start + epoch * total) + size <= 2 * target[r[0], size] for epoch in (0, 1))
            start += size
    assert 0 in wanted.values() and Counter(map(tuple, mixing.curriculum(table).collect())) == +wanted


def test_training_time_inverts_the_schedule(spark):
    for schedule in mixing.SCHEDULES:
        times = np.linspace(0, 1, 21)
        knots, weights = zip(*schedule)
        grid = np.linspace(0, 1, 100_001)
        integral = np.concatenate([[0], np.cumsum(np.interp(grid, knots, weights))[:-1]]) / 100_000
        demand = [float(np.interp(t, grid, integral) / integral[-1]) for t in times]
        frame = spark.createDataFrame([(d,) for d in demand], "d double").select(mixing.training_time(F.col("d"), schedule).alias("t"))
        assert np.allclose([r.t for r in frame.collect()], times, atol=1e-3)


def test_quality_counts(table):
    for r in quality_rules.judged(table).join(table.select("doc_id", "text"), "doc_id").collect():
        text = r.text or ""
        words = WORDS.findall(text)
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        wanted = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == wanted
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r.base_failed and r.kept)
    kept = {r.doc_id for r in quality_rules.judged(table).where("kept").collect()}
    assert {r.doc_id for r in quality_rules.passing(table.drop("_text")).collect()} == kept


def test_ops_2_and_3_run_no_python(spark):
    for name in ("op2_proportional_interleave", "op3_quality_cascade"):
        frame = registered.queries()[name](spark, SF_DIR)
        text = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
        assert not re.search("Arrow|Pandas|Python", text)


def brute_simhash(text):
    words = WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("block_pairs", [1, 256])
def test_simhash(spark, block_pairs):
    """With blocks joined pairwise, and with all linked through near fingerprints."""
    base = LONG.split(" ")[:400]
    near = [" ".join(base[:i] + ["edit"] + base[i + 1 :]) for i in range(0, 400, 40)]
    table = docs(spark, [*TEXTS, *near])
    prints = {r.doc_id: brute_simhash(r.text) for r in table.collect()}
    roots = brute_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    found = simhash.near_duplicates(table, block_pairs=block_pairs).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {(d, f"{p:016x}", roots[d]) for d, p in prints.items()}
    kept = simhash.without_near_copies(table.unionByName(table))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))


def test_without_near_copies_of_shared_ids(spark):
    """Documents without doc_id, or with one that others have, and near copies among them."""
    rng = random.Random(6)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(300))
    own = [text() for _ in range(8)]
    rows = [(None, own[0]), (None, own[1]), (None, own[2] + " end"), (7, own[3]), (7, own[4]), (7, own[3]), (None, own[3]), (9, own[5]), (7, own[5]), (None, own[6]), (None, own[6]), (8, own[2]), (3, own[7])]
    prints = [brute_simhash(t) for _, t in rows]
    roots = brute_components(range(len(rows)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    groups = defaultdict(list)
    for i, (doc, own_text) in enumerate(rows):
        groups[roots[i]].append((doc is None, doc or 0, hashlib.sha256(own_text.encode()).hexdigest(), doc, own_text))
    kept = simhash.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert Counter(map(tuple, kept.collect())) == Counter(min(g)[3:] for g in groups.values())


def test_components(spark):
    links = [(1, 2), (3, 2), (5, 4), (9, 5), (5, 5), (2, 1), *[(100 + i, 101 + i) for i in range(50)], *[(200, i) for i in range(201, 260)]]
    neighbours = {x for link in links for x in link if link[0] != link[1]}
    wanted = brute_components(sorted(neighbours), lambda a, b: (a, b) in links or (b, a) in links)
    assert {(r.node, r.root) for r in components(spark.createDataFrame(links, "a long, b long")).collect()} == set(wanted.items())


def test_byte_bpe(table):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    wanted = {d: coder.encode_ordinary(t) for d, t in texts.items()}
    coded = byte_bpe.encoded(table)
    assert {r.doc_id: r.ids for r in coded.collect()} == wanted
    assert {r.doc_id: bytes(r.bytes).decode() for r in byte_bpe.decoded(coded).collect()} == texts
    for r in byte_bpe.round_trip(table).collect():
        assert r.n_tokens == len(wanted[r.doc_id]) and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, wanted[r.doc_id])).encode()).hexdigest()


@pytest.mark.parametrize("ids", [[], [5], [0] * 700, [2**32 - 1, 0, 7], [i * i % 50_257 for i in range(999)]])
def test_range_coder(ids):
    blocks = range_coder.encode(np.array(ids, dtype=np.int64), 128)
    assert range_coder.decode(blocks).tolist() == ids
    if len(ids) > 100:
        broken = bytearray(blocks[0])
        broken[range_coder.HEADER.size] ^= 0x40
        with pytest.raises(ValueError):
            range_coder.decode([bytes(broken), *blocks[1:]])


def test_token_files(spark, table, tmp_path):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    token_store.write(table, f"{tmp_path}/tokens")
    start, wanted = 0, set()
    for r in sorted(table.collect(), key=lambda r: r.doc_id):
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        wanted.add((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert {tuple(r) for r in token_store.read(spark, f"{tmp_path}/tokens").collect()} == wanted


ARTICLE = "<article><p>The text of the page, which is long enough.</p></article>"


@pytest.mark.parametrize(
    ("html", "lines"),
    [
        (f'<div class="content with-sidebar">{ARTICLE}<div class="sidebar">side</div></div>', 1),
        (f'<div class="has-header page">{ARTICLE}</div><footer>foot</footer>', 1),
        (f'<form action="x">{ARTICLE}<input name="state"></form>', 1),
        (f'<nav><a href="/">home</a>{ARTICLE}', 1),
        (f'<aside>{ARTICLE}</aside>', 0),
        (f'<div hidden>{ARTICLE}</div>', 0),
        (f'<div class="comments"><article class="comment">{ARTICLE}</article></div>', 0),
        (f'<div class="userComments">{ARTICLE}</div>', 0),
        (f'<div class="has-comments">{ARTICLE}</div>', 1),
        (f'<nav><article>Teaser</article></nav>{ARTICLE}', 1),
        (f'<div class="related"><article>Teaser</article></div><div><p>The text of the page, which is long enough.</p></div>', 1),
    ],
)
def test_markup_around_an_article_does_not_set_it_aside(html, lines):
    assert [text for text, _ in main_text.blocks_of(html)] == ["The text of the page, which is long enough."] * lines


def test_unbalanced_tags_take_linear_time():
    import time

    start = time.perf_counter()
    assert main_text.blocks_of("<p>a" + "<b>" * 20_000 + "</i>" * 20_000) == [("a", False)]
    assert time.perf_counter() - start < 5


def test_main_text(spark):
    menu = "<nav><a>Home</a></nav><div class='side-bar sidebar'>Side</div>"
    article = "<article><h1>T &amp; U</h1><p>one<br>two  <b>three</b><p>four<div class='adBox'>buy</div><script>var t='</p>'</script><section id=comments><p>nice</p></section></article>"
    boiler = "<div>all our pages end with this long line of words</div>"
    rows = [(1, "http://h.net/1", menu + article + "<footer>f</footer>"), (2, None, None), (3, "x", "")]
    rows += [(10 + i, f"http://k.net/{i}", f"{menu}<p>number{i} here{i}</p>{boiler}") for i in range(5)]
    found = {r.page_id: r for r in main_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[1].text == "T & U\n\none two three\n\nfour" and found[1].n_chars == len(found[1].text)
    assert found[2].text == found[3].text == ""
    assert found[12].text == "number2 here2"


@pytest.mark.parametrize("partitions, broadcast", [(1, 4_000_000), (7, 0)])
def test_main_text_counts_whole_hosts(spark, monkeypatch, partitions, broadcast):
    """A large host, a notice on 1 % of it, hosts of a few pages, copies and repeated rows, against all runs of all pages."""
    monkeypatch.setattr(main_text, "BROADCAST_ROWS", broadcast, raising=False)
    rng = random.Random(5)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    everywhere, rare, copy = line(12), line(9), line(30)
    rows = []
    for i in range(700):
        rows.append((i, f"http://hot.net/{i}", f"<p>{line(20)}</p><p>{everywhere}</p>" + f"<div>{rare}</div>" * (i % 100 == 3)))
    for host in range(30):
        rows += [(1000 + 10 * host + i, f"http://h{host}.org/{i}", f"<p>{line(12)}</p><div>{everywhere}</div>") for i in range(2 + host % 3)]
    rows += [(2000 + i, f"http://copy.net/{i}", f"<p>{copy}</p>") for i in range(5)] + [(None, None, None), (7, "x", "<p>a b"), rows[0], rows[0]]
    runs = defaultdict(set)
    texts = [" ".join(re.sub("<[^>]*>", " ", h or "").split()) for _, _, h in rows]
    hosts = [(u or "x").split("/")[2:3] and u.split("/")[2] if u and "//" in u else "" for _, u, _ in rows]
    for host, text in zip(hosts, texts):
        words = text.split()
        for i in range(len(words) - 7):
            runs[host, *words[i : i + 8]].add(text)
    wanted = Counter()
    for (page, url, _), host, text in zip(rows, hosts, texts):
        words = text.split()
        covered = {i + k for i in range(len(words) - 7) if len(runs[host, *words[i : i + 8]]) >= 3 for k in range(8)}
        wanted[page, url, " ".join(w for i, w in enumerate(words) if i not in covered), len(covered)] += 1
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(partitions)
    found = Counter((r.page_id, r.url, r.text.replace("\n\n", " "), r.repeated_tokens) for r in main_text.extracted(table).collect())
    assert found == wanted


def test_url_filter(spark):
    urls = ["http://A.Example.net/en/1?x", "https://x.net/p", "http://x.net", "ftp://m.example.com/de/#t", "http://example.com/fr/", "b.org/fr/", None, "http://q.org/fr/z", "://bad.shop/", "http://notexample.com/de/"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(100 + i, f"http://bad.shop/{i}") for i in range(40)] + [(200 + i, f"http://good.shop/{i}") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    outcomes = spark.createDataFrame([(i, int(i < 200)) for i, _ in rows[len(urls) :]], "page_id long, bad int")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judged(pages, outcomes).collect()}
    assert found[0] == ("a.example.net", "/en/1", "example.net/en/", "allow") and found[1] == ("x.net", "/p", "net/", "block")
    assert found[2][:3] == ("x.net", "", None) and found[3] == ("m.example.com", "/de/", "example.com/de/", "block")
    assert found[5][:3] == found[6][:3] == ("", "", None) and found[7][2:] == ("org/fr/", "allow") and found[9][2] is None
    assert found[100][3] == "block" and found[200][3] == "allow"


def test_passages(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    shared, line = [word() for _ in range(70)], [word() for _ in range(20)]
    texts = [None, "", "few words"]
    for i in range(12):
        own = [word() for _ in range(200)]
        texts.append(" ".join(own[:90] + (shared if i < 6 else line) + own[90:]))  # a passage in six, a short line in all others
    texts.append(" ".join([word() for _ in range(30)] + shared[:40] + ["edited"] + shared[41:]))
    table = docs(spark, texts)
    found = passages.repeated_documents(passages.passage_links(table)).collect()
    assert {r.doc_id for r in found} == {3, 4, 5, 6, 7, 8, 15} and {r.class_id for r in found} == {3}
    assert all(abs(r.repeated_words - 70) <= 2 for r in found if r.doc_id not in (3,))
    values = np.array([rng.randrange(30) for _ in range(300)], dtype=np.uint64)
    starts = np.array([0, 120, 125, 300])
    wanted = set()
    for begin, end in zip(starts, starts[1:]):
        for c in range(begin, end):
            l, r = c, c
            while l > begin and values[l - 1] > values[c]:
                l -= 1
            while r < end - 1 and values[r + 1] >= values[c]:
                r += 1
            if r - l + 1 >= 10:
                wanted.add((l, c, r))
    assert set(zip(*[x.tolist() for x in passages.compact_windows(values, starts, 10)])) == wanted


@pytest.mark.parametrize("edit", range(12, 60, 4))
def test_alike_runs_with_a_repeated_phrase(edit):
    """A phrase of the passage, right after an edit, also stands ahead of the passage."""
    rng = random.Random(edit)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(75)]
    phrase = passage[edit + 1 : edit + 9]
    a = phrase + [word() for _ in range(40)] + passage
    b = [word() for _ in range(30)] + passage[:edit] + ["edited"] + passage[edit + 1 :] + [word() for _ in range(30)]
    one, two = (passages.rolled(passages.word_hashes(x), passages.SHINGLE) for x in (a, b))
    assert [r[:4] for r in passages.alike_runs(one, two, 46, 0.8)] == [(48, 118, 30, 100)]


def test_pipeline(spark):
    import corpus_pipeline

    frame = corpus_pipeline.run(spark, SF_DIR)
    assert frame.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and frame.count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_near_dedup", "mix_to_weights", "byte_bpe"]


@pytest.mark.parametrize("part", [49, 45])
def test_passages_whose_first_holder_has_a_part(spark, part):
    """Triples: the first document has a part of a passage, the other two have it whole; all pairs by brute force."""
    rng = random.Random(part)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    noise = lambda n: [word() for _ in range(n)]
    size, texts = (50 if part == 49 else 52), []
    for _ in range(60):
        passage, skip = noise(size), rng.randint(0, size - part)
        held = [passage[skip : skip + part], passage, passage]
        texts += [" ".join(noise(rng.randint(10, 80)) + own + noise(rng.randint(10, 80))) for own in held]
    links = passages.passage_links(docs(spark, texts))
    roots = {r.doc_id: r.class_id for r in passages.repeated_documents(links).collect()}
    joined = sum(3 * i + 1 in roots and roots.get(3 * i + 1) == roots.get(3 * i + 2) for i in range(60))
    assert joined >= 59
    assert all(roots[i] // 3 == i // 3 for i in roots)


def test_passages_around_a_line_that_many_hold(spark):
    """In each set ten documents hold a line that is no passage, and two of them, not the first, two more words around it: all pairs by brute force."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    noise = lambda n: [word() for _ in range(n)]
    texts, wanted = [], set()
    for i in range(100):
        line, ends = noise(48), noise(2)
        one, two = sorted(rng.sample(range(2, 10), 2))
        for j in range(10):
            held = [ends[0], *line, ends[1]] if j in (one, two) else line
            texts.append(" ".join(noise(rng.randint(10, 80)) + held + noise(rng.randint(10, 80))))
        wanted.add((10 * i + one, 10 * i + two))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    # A run of 50 words that two documents share whole.
    assert {(a, b) for i in range(0, 1000, 10) for a in range(i, i + 10) for b in range(a + 1, i + 10) if len(sets[a] & sets[b]) >= 46} == wanted
    found = passages.passage_links(docs(spark, texts))
    assert {(r.a, r.b) for r in found.where("similarity = 1").collect()} == wanted


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_neighbours_link_all_documents_of_a_group(size):
    """Groups of band + 1 documents or fewer, wherever batches end; larger ones the first and the band before."""
    rng = random.Random(size)
    rows = sorted((k, 5, rng.randrange(3 + 2 * k), rng.randrange(100), 40, 40) for k in range(8) for _ in range(4 * k + 2))
    names = ["key", "context", "doc_id", "c", "to_left", "to_right"]
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[i : i + size])], names=names) for i in range(0, len(rows), size)]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(passages.TaskContext, "get", classmethod(lambda cls: type("Task", (), {"partitionId": lambda self: 0})()))
        links = {(r["key"], r["a"], r["b"]) for b in passages.neighbours(iter(batches), 46, 8) for r in b.to_pylist() if r["f"] >= 0}
    wanted = set()
    for k in range(8):
        held = sorted({r[2] for r in rows if r[0] == k})
        wanted |= {(k, a, b) for j, b in enumerate(held) for a in {held[0], *held[max(0, j - 8) : j]} if a != b}
    assert links == wanted


def test_windows_of_several_documents():
    """Only keys of two documents or more are left, wherever batches end, and a partition's links span its batches."""
    rng = random.Random(3)
    rows = sorted((rng.randrange(40), rng.randrange(6)) for _ in range(150))
    for size in (1, 2, 7, 150):
        batches = [pa.RecordBatch.from_pydict({"key": [k for k, _ in rows[i : i + size]], "doc_id": [d for _, d in rows[i : i + size]]}) for i in range(0, 150, size)]
        found = [(r["key"], r["doc_id"]) for b in passages.of_several(iter(batches)) for r in b.to_pylist()]
        assert sorted(found) == [r for r in rows if len({d for k, d in rows if k == r[0]}) > 1]


def test_hosts_are_grouped_without_user_and_port(spark):
    wanted = {
        "example.com:8080": ("com", "example.com"),
        "u@ex.co.uk": ("co.uk", "ex.co.uk"),
        "u:p@a.b.example.org:1": ("org", "example.org"),
        "10.0.0.1": (url_filter.ADDRESS, "10.0.0.1"),
        "10.0.0.1:80": (url_filter.ADDRESS, "10.0.0.1"),
        "[::1]:80": (url_filter.ADDRESS, "[::1]"),
        "example.net.": ("net", "example.net"),
        "localhost": ("localhost", "localhost"),
        "": ("", ""),
    }
    frame = spark.createDataFrame([(h,) for h in wanted], "host string").withColumn("n", url_filter.name_of(F.col("host")))
    frame = frame.withColumn("s", url_filter.suffix_of(F.col("n"))).withColumn("d", url_filter.domain_of(F.col("n"), F.col("s")))
    assert {r.host: (r.s, r.d) for r in frame.collect()} == wanted


@pytest.mark.parametrize("listed", [False, True])
def test_reputations_against_plain_arithmetic(spark, listed):
    """Counts, priors and bounds of every level computed anew, with the strengths as the operator finds them."""
    draw = random.Random(4 + listed)
    hosts = [f"{a}{d}.{s}" for s in ("com", "co.uk", "blog.host.io", "net:81") for d in ("x", "y", "zz") for a in ("", "a.", "b.c.")] + ["10.0.0.1", "10.0.0.2:8"]
    rate = {h: draw.random() for h in hosts}
    rows = [(h, None if draw.random() < 0.2 else int(draw.random() < rate[h])) for h in hosts for _ in range(draw.randint(1, 40))]
    suffixes = spark.createDataFrame([("host.io",), ("blog.host.io",), ("blog.host.io",)], "suffix string") if listed else None
    found = {r.host: r for r in url_filter.reputations(spark.createDataFrame(rows, "host string, bad int"), suffixes).collect()}

    def levels(host):
        name = host.split(":")[0]
        if name[0].isdigit():
            return url_filter.ADDRESS, name
        tail = "blog.host.io" if listed and name.endswith("blog.host.io") else "co.uk" if name.endswith("co.uk") else name.split(".")[-1]
        return tail, ".".join(name.split(".")[-tail.count(".") - 2 :])

    counts = {"host": defaultdict(lambda: [0, 0]), "domain": defaultdict(lambda: [0, 0]), "suffix": defaultdict(lambda: [0, 0])}
    for host, bad in rows:
        if bad is not None:
            for level, key in (("host", host), ("domain", levels(host)), ("suffix", levels(host)[0])):
                counts[level][key][0] += 1
                counts[level][key][1] += bad
    k = {c: url_filter.strength(spark.createDataFrame([tuple(x) for x in own.values()], "n long, bad long")) for c, own in counts.items()}
    n, bad = (sum(x[i] for x in counts["host"].values()) for i in (0, 1))
    for host in hosts:
        mean = bad / n
        for level, key in (("suffix", levels(host)[0]), ("domain", levels(host)), ("host", host)):
            own = counts[level][key]
            mean = (k[level] * mean + own[1]) / (k[level] + own[0])
        lower = max(0.0, mean - url_filter.CONFIDENCE * (mean * (1 - mean) / (k["host"] + 1 + counts["host"][host][0])) ** 0.5)
        assert found[host].mean == pytest.approx(mean) and found[host].lower == pytest.approx(lower)
        assert (found[host].n, found[host].bad) == tuple(counts["host"][host])


def test_links_of_near_copies_grow_with_their_number(spark):
    """Twice the near copies make about twice the links, and one class; copies that share nothing with them stay apart."""
    rng = random.Random(29)
    word = lambda: f"w{rng.randrange(10**6)}"
    base, made = [word() for _ in range(240)], {}
    for size in (60, 120):
        texts = []
        for _ in range(size):
            own = list(base)
            for _ in range(4):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
        other = " ".join(word() for _ in range(80))
        links = passages.checkpointed(passages.passage_links(docs(spark, [*texts, other, other])))
        found = {r.doc_id: r for r in passages.repeated_documents(links).collect()}
        assert {i for i, r in found.items() if r.class_id == 0} == set(range(size)) and found[size + 1].class_id == size
        assert found[size + 1].repeated_words == 80
        made[size] = links.where(f"b < {size}").select("a", "b").distinct().count()
    assert made[120] < 2.5 * made[60]


def test_neighbours_of_one_class():
    """Documents of one class aren't linked, and leads of groups of three or more, or at a partition's ends, come out once."""
    rows = [(1, 5, d, 7, 40, 40, d % 2) for d in range(6)] + [(2, 5, d, 7, 40, 40, 0) for d in range(2)] + [(3, 5, d, 7, 40, 40, 0) for d in range(3)] + [(4, 5, 9, 7, 40, 40, 0)]
    names = ["key", "context", "doc_id", "c", "to_left", "to_right", "root"]
    for size in (1, 2, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[i : i + size])], names=names) for i in range(0, len(rows), size)]
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(passages.TaskContext, "get", classmethod(lambda cls: type("Task", (), {"partitionId": lambda self: 0})()))
            made = [r for b in passages.neighbours(iter(batches), 46, 32, True) for r in b.to_pylist()]
        assert {(r["key"], r["a"], r["b"]) for r in made if r["f"] >= 0} == {(1, a, b) for b in range(6) for a in range(b) if (a - b) % 2}
        assert sorted((r["key"], r["a"]) for r in made if r["f"] == passages.LEAD) == [(1, d) for d in range(6)] + [(3, d) for d in range(3)] + [(4, 9)]


def test_passages_of_two_among_many(spark):
    """Of 45 documents with a line that is no passage, the 3rd and the last share two more words; of 45 with a passage, these two share six more."""
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    noise = lambda n: [word() for _ in range(n)]
    texts = []
    for size, before, after in [(48, 1, 1)] * 3 + [(60, 0, 6)] * 3:
        line, ends = noise(size), (noise(before), noise(after))
        for j in range(45):
            held = [*ends[0], *line, *ends[1]] if j in (2, 44) else line
            texts.append(" ".join(noise(rng.randint(10, 40)) + held + noise(rng.randint(10, 40))))
    found = {r.doc_id: r for r in passages.repeated_documents(passages.checkpointed(passages.passage_links(docs(spark, texts)))).collect() if r.doc_id < len(texts)}
    for i in range(0, 135, 45):
        assert {(j, r.class_id, r.repeated_words) for j, r in found.items() if i <= j < i + 45} == {(i + 2, i + 2, 0), (i + 44, i + 2, 50)}
    for i in range(135, 270, 45):
        assert {(j, r.class_id, r.repeated_words) for j, r in found.items() if i <= j < i + 45} == {(i, i, 0), (i + 44, i, 66)} | {(j, i, 60) for j in range(i + 1, i + 44)}
