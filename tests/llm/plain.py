"""Plain restatements of the operators over lists of rows, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text):
    w = SPACED.findall(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def near_duplicates(docs):
    """{id: (n_shingles, component, kept)} of (id, text) rows without null ids."""
    sets = {i: frozenset(shingles(t)) for i, t in docs}
    lowest = {i: i for i in sets}
    changed = True
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(lowest[a], lowest[b])
            changed |= lowest[a] != low or lowest[b] != low
            lowest[a] = lowest[b] = low
    return {i: (len(sets[i]), lowest[i], lowest[i] == i) for i in sets}


def contamination(docs, items, window=10):
    """[(id, n_words, n_hit, n_items, items_sha256, contaminated)], a row for each document."""
    sought = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        for i in range(max(len(w) - window + 1, 1) if w else 0):
            sought.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    rows = []
    for i, text in docs:
        w, hit, found = ALNUM.findall(lower(text)), set(), set()
        for size in {len(s) for s in sought}:
            for k in range(len(w) - size + 1):
                for item in sought.get(tuple(w[k : k + size]), ()):
                    found.add(item)
                    hit.update(range(k, k + size))
        rows.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return rows


def line_chunks(text):
    """[(n_lines, body)] of a text."""
    lines, found, held = (text or "").split("\n"), [], []
    hashes = [int(hashlib.md5(line.encode()).hexdigest()[:8], 16) for line in lines]
    for i, line in enumerate(lines):
        held.append(line)
        rolling = sum(hashes[i - k] * 31**k for k in range(3) if i >= k)
        if rolling // 1024 % 4 == 0 or i == len(lines) - 1:
            found.append((len(held), "\n".join(held)))
            held = []
    return found


def line_dedup(docs):
    """{id: (kept_text, n_lines, n_chunks, n_removed_lines, n_removed_chunks)} of (id, text), ids distinct."""
    seen, rows = set(), {}
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        chunks, kept, gone = line_chunks(text), [], []
        for n, body in chunks:
            (gone if n > 1 and body in seen else kept).append((n, body))
            if n > 1 and body:
                seen.add(body)
        rows[i] = ("\n".join(b for _, b in kept), sum(n for n, _ in chunks), len(chunks), sum(n for n, _ in gone), len(gone))
    return rows


def _either(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_ASSIGN = re.compile(
    "(" + "|".join(map(_either, ["password", "passwd", "secret", "token", "api_?key"])) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


def luhn(number):
    doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(number))]
    return sum(doubled) % 10 == 0


def personal(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    found += [(m.start(), 1, m.end()) for m in ips if all(int(p) <= 255 for p in m[0].split("."))]
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    found += [(m.start(), 2, m.end()) for m in cards if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    found += [(m.start(), 3, m.end()) for m in phones if 10 <= len(digits(m)) <= 15]
    return [(("email", "ip", "card", "phone")[k], a, b) for a, k, b in sorted(found)]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def conversations(turns):
    """[(id, n_turns, turns_sha256, loss_chars, loss_sha256)] of (id, turn, role, text) rows."""
    groups = {}
    for c, turn, role, text in turns:
        groups.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    rows = []
    for c, held in groups.items():
        held.sort()
        loss = "".join(t for *_, role, t in held if role == "assistant")
        rows.append((c, len(held), sha("".join(f"{r}\n{t}\n" for *_, r, t in held)), len(loss), sha(loss)))
    return rows


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)"""
    text = text or ""
    w = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeat = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    n, chars, symbols, dup = len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines))
    base = n < 50 or 100 * len(repeat) > 50 * n
    more = chars < 2 * n or chars > 20 * n or 10 * symbols > 3 * n or (dup >= 5 and 15 * dup > n)
    return n, chars, symbols, dup, len(repeat), base, not (base or more)


def targets(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    """{source: target} by sharing out again and again what capped sources leave."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    held = set()
    while True:
        left = share * sum(sizes.values()) - sum(epochs * sizes[s] for s in held)
        free = [s for s in order if s not in held]
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > epochs * sizes[s]}
        if not over:
            return {s: float(epochs * sizes[s]) if s in held else level * weight[s] for s in order}
        held |= over


def kept_bytes(docs, length=100):
    """{id: (n_bytes, n_removed, n_spans, kept_sha256)} of (id, text) rows, ids distinct."""
    seen, rows = set(), {}
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if b[k : k + length] in seen:
                gone[k : k + length] = True
            seen.add(b[k : k + length])
        left = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int(np.sum(np.diff(np.concatenate(([False], gone)).astype(int)) == 1))
        rows[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
    return rows


def token_rows(docs, path, end_id=0):
    """[(id, start, n_tokens, crc32)] of (id, text) rows."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    rows, at = [], 0
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        rows.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return rows
