"""The queries against brute force, the library they must equal, SQL, or held-out labels, on the smallest tables."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from rollcall.llm import token_counts
from tests.compare import DATA, both, views

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return views(SF).execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


def run(spark, name):
    return entry.queries()[name](spark, SF).collect()


def test_token_counts_are_those_of_the_library(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    tok.no_truncation()
    tok.no_padding()
    want = {i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t, _ in docs}
    assert {r["doc_id"]: r["n_tokens"] for r in run(spark, "op3_token_counts")} == want


def test_repeats_are_those_of_brute_force(spark, docs):
    first: dict[bytes, int] = {}
    bodies = {i: (t or "").encode() for i, t, _ in docs}
    for i in sorted(bodies):
        for k in range(len(bodies[i]) - 49):
            first.setdefault(bodies[i][k : k + 50], i)
    got = {r["doc_id"]: r for r in run(spark, "op8_repeated_strings")}
    for i, b in bodies.items():
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), i


def test_near_duplicates_are_those_of_all_pairs(spark, docs):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t, _ in docs if (w := (t or "").lower().split())}
    group = {i: i for i, _, _ in docs}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                group[y] = x
    got = {r["doc_id"]: r["class_id"] for r in run(spark, "op5_minhash_dedup")}
    assert all(got[i] == got[top(i)] for i in group)  # no link is lost; weighted shingles may add some
    assert sum(got[i] != top(i) for i in group) <= 0.02 * len(group)


def test_links_are_those_of_all_cosines(spark):
    rows = views(SF).execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    x = np.stack([v / np.linalg.norm(v) for _, v in good])
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    want = {i: int(n) for (i, _), n in zip(good, near.sum(1), strict=True)}
    got = {r["vec_id"]: r["n_links"] for r in run(spark, "op7_embedding_dedup")}
    assert all(got[i] <= n for i, n in want.items())
    assert sum(got[i] for i in want) >= 0.9 * sum(want.values())


def test_base_scores_are_exact(spark, docs):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    words = {i: (t or "").encode().translate(lower).split() for i, t, _ in docs}
    train = [i for i in words if zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for i in train for w in [*words[i], None])
    n, v = sum(c.values()), len(c)
    for r in run(spark, "op2_lm_score"):
        tokens = [*words[r["doc_id"]], None]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(c[w] > 0 for w in tokens), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens), rel_tol=1e-9)
        assert r["score"] < 0


def test_held_out_languages(spark, docs):
    lang = {i: x for i, _, x in docs}
    held = [r for r in run(spark, "op1_language_id") if r["held_out"] and lang[r["doc_id"]] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.9 * len(held) > 0


def test_toxicity_scores(spark, docs):
    out = run(spark, "op6_toxicity")
    assert len(out) == len(docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)


def test_held_out_toxic_labels(spark):
    """Of labelled texts that no dictionary or threshold has seen: most toxic ones are caught, clean ones left alone."""
    folder = f"{DATA}/sf0.1"
    toxic = dict(views(folder).execute("SELECT doc_id, toxic FROM labels WHERE toxic IS NOT NULL").fetchall())
    held = [(r["predicted"], toxic[r["doc_id"]]) for r in entry.queries()["op6_toxicity"](spark, folder).collect() if r["held_out"] and r["doc_id"] in toxic]
    caught, bad = sum(p and t for p, t in held), sum(t for _, t in held)
    spared, good = sum(not p and not t for p, t in held), sum(not t for _, t in held)
    assert bad > 90 and good > 700
    assert caught >= 0.7 * bad and spared >= 0.98 * good


def test_mixture_equals_its_sql(spark):
    columns, got, names, want = both(spark, entry.queries()["op4_mixture"], entry.oracle_sql()["op4_mixture"], SF)
    assert columns == names and got == want


def test_pages_and_pipeline_have_rows(spark):
    n = views(SF).execute("SELECT count(*) FROM pages").fetchone()[0]
    assert len(run(spark, "op9_main_text")) == n
    taken = run(spark, "pipeline")
    assert taken and len({r["doc_id"] for r in taken}) == len(taken)
