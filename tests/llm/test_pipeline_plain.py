"""The pipeline and language ID against plain versions: loops, dictionaries, regular expressions and the tokenizers library."""

import collections
import math
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa

import corpus_pipeline
from tests.llm import fixtures
from tests.llm.test_bytes import reference_ids
from tests.llm.test_text_dedup import near_groups
from tidemark.llm import langid, secrets

WORDS = re.compile(r"[^\x20\x09-\x0D]")
RULES = [(kind, re.compile(pattern), least) for kind, pattern, least in (*secrets.BASE, *secrets.EXTRA)]


def trigrams(text):
    fold = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode()]
    found = collections.Counter()
    for a, b, c in zip([32, *fold], fold, [*fold[1:], 32]):
        if b != 32:
            h = (a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) % 2**32
            found[((h ^ (h >> 15)) * 0x2C1B3C6D) % 2**32 >> 16] += 1
    return found


def rounds(like, counts, share, n):
    """Expectation-maximisation, one trigram at a time; then the log likelihood."""
    for _ in range(n):
        total = [0.0] * len(share)
        for row, count in zip(like, counts):
            weights = [s * p for s, p in zip(share, row)]
            for k, w in enumerate(weights):
                total[k] += count * w / sum(weights)
        share = [t / sum(total) for t in total]
    return share, sum(c * math.log(sum(s * p for s, p in zip(share, row))) for row, c in zip(like, counts))


def plain_languages(rows):
    """(lang_pred, score) of each row's text, learned from the rows that are not held out."""
    counts = collections.defaultdict(collections.Counter)
    for doc_id, text, lang, *_ in rows:
        if lang is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2:
            counts[lang].update(trigrams(text))
    languages = sorted(counts)
    whole = {k: sum(counts[k].values()) + langid.SMOOTHING * langid.FEATURES for k in languages}
    out = []
    for _, text, *_ in rows:
        found = trigrams(text or "")
        if not any(unicodedata.category(c).startswith("L") for c in text or ""):
            out.append(("und", 0.0))
            continue
        like = [[(counts[k][f] + langid.SMOOTHING) / whole[k] for k in languages] for f in found]
        tokens, n = list(found.values()), sum(found.values())
        single = [sum(c * math.log(row[k]) for row, c in zip(like, tokens)) for k in range(len(languages))]
        held = [float(k == single.index(max(single))) for k in range(len(languages))]
        best, penalty = max(single), langid.SHARE_PENALTY * n + 0.5 * math.log(n + 1)
        full, likelihood = rounds(like, tokens, [1 / len(languages)] * len(languages), langid.ROUNDS)
        if likelihood - penalty > best:
            ranked = sorted(range(len(languages)), key=lambda k: -full[k])
            for size in range(2, len(languages) + 1):
                start = [full[k] + 1e-6 if k in ranked[:size] else 0.0 for k in range(len(languages))]
                share, likelihood = rounds(like, tokens, [s / sum(start) for s in start], 6)
                if likelihood - (size - 1) * penalty > best:
                    held, best = share, likelihood - (size - 1) * penalty
        out.append((languages[held.index(max(held))], max(held)))
    return out


def without_later_copies(texts, length=200):
    """Cuts what a string of ``length`` bytes covers that starts earlier too; whole characters only."""
    seen, out = set(), []
    for text in texts:
        raw = text.encode()
        keep = np.ones(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                keep[i : i + length] = False
            seen.add(raw[i : i + length])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (~keep).astype(int), [0]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            inside = [k for k in range(a, b + 1) if k == len(raw) or raw[k] & 0xC0 != 0x80]
            keep[a:b] = True
            keep[inside[0] : inside[-1]] = False
        out.append(np.frombuffer(raw, np.uint8)[keep].tobytes().decode())
    return out


def blacked_out(text):
    spans = []
    for kind, rule, least in RULES:
        for m in rule.finditer(text):
            value = re.split("[:=]", m[0], maxsplit=1)[1].lstrip(" ") if kind == "assign" else m[0]
            if len(value) - (kind == "assign" and value[:1] in ("'", '"')) >= least:
                spans.append(m.span())
    out, done = "", 0
    for a, b in sorted(spans):
        if b > done:
            out += text[done:a] + "[REDACTED]" if a >= done else ""
            done = b
    return out + text[done:]


def plain_pipeline(rows):
    """(doc_id, text) of what reaches packing."""
    left = [r for r, (lang, share) in zip(rows, plain_languages(rows)) if lang != "und" and share >= corpus_pipeline.LEAST_SHARE]
    left = [r for r in left if WORDS.search(r[1])]
    kept = near_groups(list({r[0]: r for r in left}.values()))
    left = sorted({r[0]: r[1] for r in left if kept[r[0]][2]}.items())
    return [(doc_id, blacked_out(text)) for (doc_id, _), text in zip(left, without_later_copies([t for _, t in left]))]


def test_predictions_are_those_of_plain_inference(spark):
    rows = fixtures.rows(3, 150)
    docs = fixtures.table(spark, 3, 150)
    got = {r.doc_id: r for r in langid.identify(docs, docs.where(~langid.held_out()), ["doc_id"]).collect()}
    want = plain_languages(rows)
    for r, (lang, score) in zip(rows, want):
        assert got[r[0]].lang_pred == lang and math.isclose(got[r[0]].score, score, abs_tol=2e-3), r[0]
    assert sum(0 < score < 0.99 for _, score in want) > 5  # texts in two languages are among them


def test_the_pipeline_is_that_of_plain_stages(spark, tmp_path):
    rows = fixtures.rows(5, 160)
    fixtures.table(spark, 5, 160).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = collections.defaultdict(list)
    windows = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    want = plain_pipeline(rows)
    assert sorted(got) == [doc_id for doc_id, _ in want]
    assert 100 < len(want) < len(rows) and any("[REDACTED]" in text for _, text in want)
    for doc_id, text in want:
        ids = np.array([*reference_ids(text)[0], 1], "<u4")
        at = 0
        for r in sorted(got[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes())), doc_id
            at += r.length
        assert at == len(ids)
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_plain_redaction_follows_the_rules():
    text = "token=abcdefghijkl AKIA" + "A1" * 9 + " see ghp_" + "aB3" * 13 + " and https://joe:hunter22@host short token=abc"
    assert blacked_out(text) == "[REDACTED] [REDACTED] see [REDACTED] and https[REDACTED]host short token=abc"
    assert [len(x) for x in secrets.find_secrets(pa.array([text]), secrets.scanner())] == [4]
