"""Plain Python versions of the operators, and tables with the awkward cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, lower=False):
    return SPACED.findall((text or "").translate(LOWER) if lower else text or "")


def vocabulary(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopéüñ") for _ in range(rng.randint(1, 8))) for _ in range(n)]


def corpus(n=60, seed=1, common=20):
    """Random texts, exact copies, near copies, shared passages, null, empty and blank ones, one long text."""
    rng, vocab = random.Random(seed), vocabulary(300, seed)
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage = text(common)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and rows:
            rows.append(rng.choice(rows))
        elif kind == 2 and rows:
            w = (rng.choice(rows) or "x").split()
            if w:
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append(" ".join(w))
        elif kind == 3:
            rows.append(f"{text(rng.randint(0, 30))} {passage}\n{text(rng.randint(0, 30))}")
        else:
            rows.append(text(rng.randint(0, 90)))
    rows += [None, "", " \t\n ", "One", "one", "A b", "a  B", text(4000), rows[-1], "x " * 500, "\x1c\x85 ünï x"]
    return [(i, t) for i, t in enumerate(rows)]


def decontaminated(docs, items, k=10):
    wins = defaultdict(set)
    for item, text in items:
        w = NORMAL.findall((text or "").translate(LOWER))
        n = min(k, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[i:i + n])].add("null" if item is None else str(item))
    out = {}
    sizes = {len(x) for x in wins}
    for doc, text in docs:
        w = NORMAL.findall((text or "").translate(LOWER))
        hit, ids = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if got := wins.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    ids |= got
        out[doc] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))
    return out


def shingles(text, k):
    w = words(text, lower=True)
    n = min(k, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def near_groups(docs, k=4, num=85, den=100):
    sets = {d: shingles(t, k) for d, t in docs}
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            common = len(sets[a] & sets[b])
            if common and den * common >= num * len(sets[a] | sets[b]):
                ra, rb = find(a), find(b)
                top[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), find(d)) for d in ids}


def without_repeats(docs, k=13):
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - k + 1):
            key = tuple(w[i:i + k])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, t in docs:
        w, gone = words(t), set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < d:
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def quality_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered.update(range(i, i + 5))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 if d > 4 else d * 2
    return total % 10 == 0


def _digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle_leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return _digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def merkle(rows):
    """doc_id, leaf, subroot, root, digest of the proof, folded root of each row."""

    def up(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([_digest(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
        return levels

    def way(levels, i):
        for level in levels[:-1]:
            a = i // 16 * 16
            yield level[a:i], level[i + 1:a + 16]
            i //= 16

    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, merkle_leaf(r, r["text"])))
        trees[s] = up([merkle_leaf(r, r["text"]) for r in groups[s]])
    top = up([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            path = [*way(trees[s], i), *way(top, k)]
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            h = merkle_leaf(r, r["text"].translate(LOWER) if hit and r["text"] is not None else r["text"])
            for a, b in path:
                h = _digest(*a, h, *b)
            out.append((r["doc_id"], trees[s][0][i], trees[s][-1][0], top[-1][0], _digest(*[x for a, b in path for x in a + b]), h))
    return out


def aligned(docs, a_path, b_path, a_bytes, b_bytes):
    """doc -> n_a, n_b, n_groups, n_links, n_best, count_sum, groups; whole texts, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(a_path)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=b_path)

    def spans(parts):
        at = 0
        for x in parts:
            yield at, at + len(x)
            at += len(x)

    found, count = {}, Counter()
    for doc, text in docs:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        pa, pb = [a_bytes[i] for i in a], [b_bytes[i] for i in b]
        if not text or not b"".join(pa) == b"".join(pb) == (" " + text).encode():
            found[doc] = None
            continue
        sa, sb = list(spans(pa)), list(spans(pb))
        links, low = [], 0
        for (x, y), i in zip(sa, a):
            while sb[low][1] <= x:
                low += 1
            k = low
            while k < len(sb) and sb[k][0] < y:
                links.append((i, b[k]))
                k += 1
        ends = {y for _, y in sa} & {y for _, y in sb}
        groups, own = [], ([], [])
        todo = sorted([(y, 0, i) for (_, y), i in zip(sa, a)] + [(y, 1, i) for (_, y), i in zip(sb, b)], key=lambda t: t[0])
        for k, (y, which, i) in enumerate(todo):
            own[which].append(i)
            if y in ends and (k + 1 == len(todo) or todo[k + 1][0] > y):
                groups.append("|".join(",".join(map(str, x)) for x in own))
                own = ([], [])
        found[doc] = (len(a), len(b), len(groups), links, ";".join(groups))
        count.update(set(links))
    best = Counter()
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return {doc: (0, 0, 0, 0, 0, 0, "") if f is None else
            (*f[:3], len(f[3]), sum(count[x] == best[x[0]] for x in f[3]), sum(count[x] for x in f[3]), f[4]) for doc, f in found.items()}
