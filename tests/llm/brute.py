"""Plain restatements of what the operators must return."""

import collections
import hashlib
import re
import zlib
from collections import Counter


def components(rows):
    """(doc_id, size of the set, component) for (doc_id, text)."""

    def shingles(text):
        w = (text or "").encode("utf-8", "surrogatepass").lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t in rows]
    same, index, parent = {}, collections.defaultdict(list), []
    for i, s in enumerate(sets):
        same.setdefault(s, []).append(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct = [s for s in same if s]
    for k, s in enumerate(distinct):
        parent.append(k)
        common = collections.Counter(o for g in s for o in index[g])
        for g in s:
            index[g].append(k)
        for o, n in common.items():
            if 100 * n >= 75 * (len(s) + len(distinct[o]) - n):
                parent[root(k)] = root(o)
    groups = collections.defaultdict(list)
    for k, s in enumerate(distinct):
        groups[root(k)] += same[s]
    out = [(d, 0, d) for d, _ in rows]
    for members in groups.values():
        known = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = (rows[i][0], len(sets[i]), min(known) if known else None)
    return out


def top_k(vectors, k=10):
    import math

    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n_q, (q, a) in enumerate(whole):
        if q % 100 == 0:
            score = lambda b: min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1)  # noqa: B023, E731  a long, as the contract asks
            found = sorted((-score(b), i) for n_b, (i, b) in enumerate(whole) if n_b != n_q and len(a) == len(b))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return out


def without_repeats(rows):
    """(doc_id, bytes, removed, runs, sha256) for (doc_id, text)."""
    last = (True, 0)
    data = [((d is None, d or 0), (t or "").encode("utf-8", "surrogatepass")) for d, t in rows]
    lowest = {}
    for d, b in data:
        for i in range(len(b) - 49):
            lowest[b[i : i + 50]] = min(d, lowest.get(b[i : i + 50], last))
    out = []
    for (doc_id, _), (d, b) in zip(rows, data):
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if lowest[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def without_repeated_runs(rows, sentences, least_sentences, least_words):
    """{doc_id: remaining text} for (doc_id, text) with distinct ids, hashing every run of sentences of any length."""
    runs = []
    for d, t in rows:
        parts = sentences(t or "")
        said = [re.sub(r"[^\w\s]+", " ", p.lower()).split() for p in parts]
        for a in range(len(parts)):
            for z in range(a + 1, len(parts) + 1):
                words = sum(said[a:z], [])
                if said[a] and (z - a >= least_sentences and len(words) >= least_words or z - a == 1 and len(words) >= 2 * least_words):
                    runs.append((tuple(words), (d is None, d or 0, a), d, a, z))
    first = {}
    for key, place, *_ in runs:
        first[key] = min(place, first.get(key, place))
    gone = {(d, i) for key, place, d, a, z in runs if place != first[key] for i in range(a, z)}
    return {d: None if t is None else "".join(p for i, p in enumerate(sentences(t)) if (d, i) not in gone) for d, t in rows}


def languages(rows, size):
    """{doc_id: (held out, language, score)} for (doc_id, text, lang)."""
    import zlib

    def grams(text):
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        out = collections.Counter()
        for i, w in enumerate(words):
            out.update(w)
            out.update(a + b for a, b in zip("_" + w, w + "_"))
            out.update(a + b + c for a, b, c in zip("_" + w, w + "_", w[1:] + "_"))
        return out

    def number(g):  # a border is larger than any letter
        n = 0
        for c in g:
            n = n << 21 | (0x1FFFFF if c == "_" else ord(c))
        return n

    def ranked(counts):
        return sorted(counts, key=lambda g: (-counts[g], number(g)))[:size]

    out = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    learned = collections.defaultdict(collections.Counter)
    for d, t, lang in rows:
        if not out(d) and lang is not None and t is not None:
            learned[lang].update(grams(t))
    profiles = {lang: {g: i for i, g in enumerate(ranked(c))} for lang, c in sorted(learned.items()) if c}
    found = {}
    for d, t, _ in rows:
        top = ranked(grams(t))
        if not top:
            found[d] = (out(d), "und", 0.0)
            continue
        distance = {lang: sum(abs(i - p[g]) if g in p else size for i, g in enumerate(top)) for lang, p in profiles.items()}
        best = min(distance, key=lambda lang: (distance[lang], lang))
        found[d] = (out(d), best, round(1 - distance[best] / (len(top) * size), 9))
    return found


def licences(files, templates, threshold):
    """(doc_id, licence, score, origin) for (doc_id, path, text); every segment against every template it is held against."""
    import math

    term = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
    said = lambda t: term.findall((t or "").lower())
    known = {w for ts in templates.values() for t in ts for w in said(t)}
    df = collections.Counter(w for _, _, t in files for w in set(said(t)))
    weight = lambda w: math.log((1 + len(files)) / (1 + (df[w] if w in known else 0))) + 1

    def vector(words):
        v = {w: n * weight(w) for w, n in collections.Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    held = [(name, said(t), vector(said(t))) for name, ts in templates.items() for t in ts]
    own = []
    for d, path, text in files:
        words, best, spans, runs = said(text), None, [], collections.defaultdict(list)
        low, at = (text or "").lower(), 0
        pieces = [(0, len(words), held)]
        for line in low.split("\n"):
            n = len(said(line))
            pieces.append((at, at + n, held))
            at += n
        for h in held:
            n = len(h[1])
            if known & set(words) and len(words) < 5000:
                pieces += [(a, a + n, [h]) for a in range(len(words) - n + 1)]
            elif len(words) >= 5000:  # only where the words of a template are
                pieces += [(a, a + n, [h]) for a in range(len(words) - n + 1) if sum(w in h[2] for w in words[a : a + n]) > n // 3]
        for a, z, among in pieces:
            if z > a and known & set(words[a:z]):
                v = vector(words[a:z])
                for name, form, t in among:
                    c = sum(x * t.get(w, 0.0) for w, x in v.items())
                    if c >= threshold:
                        if among is held:
                            spans.append((a, z))
                        else:
                            runs[name, tuple(form)].append((-round(c * c, 9), a, z))
                        if best is None or (-round(c, 9), name) < (-best[0], best[1]):
                            best = (round(c, 9), name)
        for hits in runs.values():  # of a template's runs that overlap, the best stays
            stay = []
            for _, a, z in sorted(hits):
                if all(z <= x or y <= a for x, y in stay):
                    stay.append((a, z))
            spans += stay
        own.append((d, path, best, words, spans))
    inside = {}
    for d, path, best, words, spans in own:
        covered = len({i for a, z in spans for i in range(a, z)}) / max(1, len(words))
        if best and path is not None and (covered >= 0.5 or re.search(r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$", path)):
            key = path.rpartition("/")[0]
            inside[key] = min(inside.get(key, (0, "~")), (-best[0], path, best[1]))
    out = []
    for d, path, best, _, _ in own:
        if best:
            out.append((d, best[1], round(best[0], 6), "own"))
            continue
        at, got = path, None
        while at and got is None:
            at = at.rpartition("/")[0]
            got = inside.get(at)
        if got is None and path is not None:
            got = inside.get("")
        out.append((d, got[2], round(-got[0], 6), "inherited") if got else (d, None, None, None))
    return out


def least_edits(item, text):
    """The edits between item and the piece of text nearest to it."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (x != c), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def secrets(text):
    """kind:start:end of every finding."""
    text = text or ""
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in sorted(found)]


def phrases(rows, least, longest=5, top=2000, covered=100):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by_lang, out = {}, []
    for lang, text in rows:
        by_lang.setdefault("und" if lang is None else lang, []).append(text or "")
    for lang, texts in by_lang.items():
        f, n = Counter(), 0
        for text in texts:
            for piece in re.split("[.,;:!?\x0a-\x0d]", text.translate(low)):
                w = re.findall("[^\x20\x09]+", piece)
                n += len(w)
                for m in range(1, longest + 1):
                    f.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= covered * f[p[i:j]]}
        scored = []
        for p in often.keys() - gone:
            score, k = min((1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -f[p], " ".join(p).encode(), " ".join(p), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p, -a, left, right, n, -score) for rank, (score, a, _, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return out


def dealt(rows, n):
    """(doc_id, size, crc32, law, shard, slot, None) of (doc_id, text) rows."""
    sized = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows]
    sized.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    total, before, slots, out = sum(r[1] for r in sized), 0, Counter(), []
    for d, size, crc in sized:
        shard = (2 * before + size) * n // (2 * total)
        before += size
        out.append((d, size, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
    return out


def middles(rows):
    """(doc_id, n, form, prefix_chars, middle_chars, sha256 of the output, sha256 of the text) of (doc_id, text) rows."""
    out = []
    for d, text in rows:
        text = text or ""
        units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        h = hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
        a, z = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:z]), "".join(units[z:])
        form = "plain" if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50 else "spm" if h4 % 100 < 80 else "psm"
        made = {"plain": text, "psm": f"<P>{prefix}<S>{suffix}<M>{middle}", "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}[form]
        sizes = (None, None) if form == "plain" else (len(prefix), len(middle))
        out.append((d, len(units), form, *sizes, hashlib.sha256(made.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return out
