"""Plain single-machine versions of the operators' contracts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def decontamination(docs, items, size=13):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (names := windows.get(tuple(words[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= names
        names = ",".join(sorted(found))
        out.append(
            (doc, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
             len(hit) > 0 and 20 * len(hit) >= len(words))
        )
    return out


def token_counts(docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    out = []
    for doc, text in docs:
        n = len(model.encode(text or ""))
        out.append((doc, len((text or "").encode()), n, n > 4096))
    return out


def pieces(docs, capacity=2048):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    out = []
    for doc, text in docs:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
        for n, (a, b) in enumerate(zip(edges, edges[1:])):
            raw = b"".join(i.to_bytes(4, "little") for i in ids[a:b])
            out.append((doc, n, a, b - a, zlib.crc32(raw)))
    return out


def quality(docs):
    out = []
    for doc, text in docs:
        text = text or ""
        words = PLAIN.findall(text)
        lines = [x for x in text.split("\n") if PLAIN.search(x)]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        count = Counter(windows)
        covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
        n = len(words)
        out.append(
            (doc, n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
             len(covered), n < 20 or 100 * len(covered) > 30 * n)
        )
    return out


def removed_bytes(docs, size=100):
    """Per document: bytes, removed, spans and digest, by comparing all windows."""
    first = {}
    rows = sorted((d, (t or "").encode()) for d, t in docs)
    for doc, body in rows:
        for i in range(len(body) - size + 1):
            first.setdefault(body[i : i + size], (doc, i))
    out = []
    for doc, body in rows:
        gone = bytearray(len(body))
        for i in range(len(body) - size + 1):
            if first[body[i : i + size]] != (doc, i):
                gone[i : i + size] = b"\x01" * size
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((doc, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size):
    words = PLAIN.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def components(docs, size=4, percent=85):
    sets = [(d, shingles(t, size)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return [(d, len(s), find(d)) for d, s in sets]


def one_edit_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling(docs, min_length=5, min_count=3):
    count = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= min_length and n >= min_count}
    masks = defaultdict(set)  # words that are near share one with a letter masked or cut
    for w in words:
        for i in range(len(w)):
            masks[w[:i] + "\0" + w[i + 1 :]].add(w)
            masks[w[:i] + w[i + 1 :]].add(w)
        masks[w].add(w)
    near = defaultdict(set)
    for same in masks.values():
        for a in same:
            near[a] |= {b for b in same if b not in near[a] and one_edit_apart(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def exact_groups(docs):
    digest = lambda t: hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()
    groups = defaultdict(list)
    for doc, text in docs:
        groups[digest(text)].append(doc)
    rank = lambda d: (d is not None, d or 0)
    out = []
    for key, ids in groups.items():
        ids = sorted(ids, key=rank)
        out += [(d, ids[-1], len(ids), i == len(ids) - 1, key) for i, d in enumerate(ids)]
    return out
