"""Every registered query of the numbered operators on its whole table
against brute force (or SQL)."""

import hashlib
import math
from collections import Counter, defaultdict

import duckdb
import pytest

from feedlens.llm import queries
from tests.llm import brute

SF = "/root/testdata/sf0.01"
REG = queries.registry()


def rows(table, columns):
    return duckdb.sql(f"select {columns} from '{SF}/{table}.parquet'").fetchall()


@pytest.fixture(scope="module")
def docs():
    return rows("documents", "doc_id, text")


def test_near_dedup(spark, docs):
    got = REG["op1_near_dedup"](spark, SF).collect()
    want = brute.near_duplicates(docs, 3, 85, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(docs) and all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert any(not r.kept for r in got)


def test_warc(spark):
    got = REG["op2_warc"](spark, SF).collect()
    want = brute.warc(rows("pages", "page_id, html"))
    assert len(got) == len(want)
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want


def test_html_text(spark):
    got = {r.page_id: r for r in REG["op3_html_text"](spark, SF).collect()}
    pages = rows("pages", "page_id, url, html")
    assert len(got) == len(pages)
    for page_id, url, html in pages:
        r = got[page_id]
        assert (r.url, r.text, r.n_chars) == (url, brute.article(html), len(r.text)), page_id


def test_mixing(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as from '{SF}/documents.parquet'")
    want = con.sql(queries.MIXING_SQL)
    order = [c for c in want.columns]
    got = REG["op4_mixing"](spark, SF).select(*order).collect()
    fix = lambda r: tuple(round(x, 4) if isinstance(x, float) else x for x in r)
    assert Counter(map(fix, got)) == Counter(map(fix, want.fetchall()))
    size, target, taken = {}, {}, Counter()
    for r in got:
        size[r.source], target[r.source] = r.source_size, r.target
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    assert math.isclose(sum(target.values()), sum(size.values()))
    assert all(target[s] <= 3 * size[s] + 1e-6 for s in size)
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] for s in size)


def test_sharding(spark, docs):
    got = REG["op5_sharding"](spark, SF).collect()
    check_shards(got, docs, 24)
    again = {r.doc_id: (r.shard, r.slot) for r in REG["op5_sharding"](spark, SF).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in got}


def check_shards(got, docs, n_shards):
    import zlib
    text = dict(docs)
    assert len(got) == len(docs)
    slots = defaultdict(list)
    for r in got:
        data = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(n_shards))
    counts = [len(slots[k]) for k in range(n_shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # equal texts are in as few shards as can hold them
    shards, size = defaultdict(set), Counter()
    for r in got:
        shards[text[r.doc_id]].add(r.shard)
        size[text[r.doc_id]] += 1
    cut = sum(len(s) > math.ceil(size[t] / min(counts)) for t, s in shards.items() if size[t] > 1)
    groups = sum(n > 1 for n in size.values())
    assert cut <= max(1, 0.1 * groups), (cut, groups)


def test_secrets(spark, docs):
    got = {r.doc_id: r for r in REG["op6_secrets"](spark, SF).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        base, r = brute.secrets(text), got[doc_id]
        kinds = Counter(k for _, k, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds[0], kinds[1], kinds[2])
        assert r.base_sha256 == hashlib.sha256(brute.spans(base).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert [x for x in every if not x.startswith("markov")] == [x for x in brute.spans(base).split(",") if x]


def test_quality(spark, docs):
    got = {r.doc_id: r for r in REG["op7_quality"](spark, SF).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        r, want = got[doc_id], brute.quality(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, doc_id
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)
    labels = dict(rows("labels", "doc_id, quality"))
    ok = [r.kept == bool(labels[i]) for i, r in got.items() if i in labels and not r.base_failed]
    assert sum(ok) / len(ok) > 0.9


def test_quality_distances(spark):
    """Both distances and the verdict of every document, references included."""
    from feedlens.llm import quality as q
    got = {r.doc_id: r for r in REG["op7_quality"](spark, SF).collect()}
    rows_ = rows("documents", "doc_id, text, lang")
    own = {i: (lang, brute.histograms(t or "", q.COMMON.get(lang)), len(t or "")) for i, t, lang in rows_}
    good = [own[i] for i, y in rows("labels", "doc_id, quality") if y == 1 and i in own]
    good = [(lang, h) for lang, h, n in good if n >= q.MIN_CHARS and h[2] >= q.LONG_WORDS]
    mean = lambda k, lang: [sum(x) / len(x) for x in zip(*(h[k] for la, h in good if la == lang))]
    refs = {lang: (mean(0, lang), mean(1, lang)) for lang in {la for la, _ in good}}
    assert set(refs) == {"en", "de", "fr", "es"}
    for i, (lang, (chars, words, n), size) in own.items():
        r, limit = got[i], q.MAX_SHORT_JOINT_DISTANCE if n < q.LONG_WORDS else q.MAX_JOINT_DISTANCE
        c = brute.js_distance(chars, refs[lang][0]) if size >= q.MIN_CHARS or n >= q.MIN_WORDS else None
        w = brute.js_distance(words, refs[lang][1]) if n >= q.MIN_WORDS else None
        assert r.class_distance == (c if c is None else pytest.approx(c, abs=1e-6)), i
        assert r.word_distance == (w if w is None else pytest.approx(w, abs=1e-6)), i
        joint = None if c is None or w is None else math.sqrt((c * c + w * w) / 2)
        if all(x is None or abs(x - y) > 1e-6 for x, y in ((c, q.MAX_CLASS_DISTANCE), (joint, limit))):
            far = c is not None and c > q.MAX_CLASS_DISTANCE or joint is not None and joint > limit
            assert r.kept == (not r.base_failed and not far), i


def test_token_counts(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in REG["op8_token_counts"](spark, SF).collect()}
    assert len(got) == len(docs)
    for (doc_id, text), e in zip(docs, tok.encode_batch([t or "" for _, t in docs], add_special_tokens=False)):
        r = got[doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((text or "").encode()), len(e.ids), len(e.ids) > 512)


def test_decontamination(spark, docs):
    got = REG["op9_decontamination"](spark, SF).collect()
    want = brute.contained(docs, rows("benchmark", "item_id, text"))
    assert {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in got} == want and len(got) == len(want) > 0


def test_chat(spark):
    got = {r.conv_id: r for r in REG["op10_chat"](spark, SF).collect()}
    convs = defaultdict(list)
    for conv, _, role, text in sorted(rows("conversations", "conv_id, turn, role, text")):
        convs[conv].append((role, text))
    probe = "\\### Assistant: </turn> ok"
    convs[-7] = [("user", probe), ("assistant", probe)]
    assert set(got) == set(convs)
    for conv, turns in convs.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == brute.chat(turns)
        assert r.formatted_chars >= sum(len(x or "") + len(t or "") for x, t in turns)


def test_pipeline(spark):
    """Each stage against the brute force of its operator, on its own input."""
    import corpus_pipeline as p
    cur = spark.read.parquet(f"{SF}/documents.parquet")
    items = rows("benchmark", "item_id, text")
    for k, (_, stage) in enumerate(p.STAGES):
        before = cur.collect()
        cur = stage(spark, cur, SF)
        after = cur.collect()
        if k < 4:
            assert cur.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert set(after) <= set(before)
        ids = {r.doc_id for r in after}
        if k == 0:
            assert not any(brute.quality(r.text)[0] < 50 for r in after) and 0.7 * len(before) < len(after) < len(before)
        elif k == 1:
            want = brute.near_duplicates([(r.doc_id, r.text) for r in before], 5, 80, 100)
            assert ids == {i for i, (_, c) in want.items() if i == c} and len(after) == len(ids)
        elif k == 2:
            bad = {d for d, _ in brute.contained([(r.doc_id, r.text) for r in before], items)}
            assert ids == {r.doc_id for r in before} - bad
        elif k == 3:
            assert 1 < max(Counter(r.doc_id for r in after).values()) <= 3
        else:
            check_shards(after, [(r.doc_id, r.text) for r in before], 24)
    assert REG["pipeline"](spark, SF).count() == len(after)
