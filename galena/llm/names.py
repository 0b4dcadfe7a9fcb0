"""Names of organisations and people as typed: words, a symmetric-delete index over them, alignment of two names."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galena.session import materialize

# Accented capitals and what they become; words that carry no name (legal forms, titles, articles and
# what announces them); words of activity with their usual abbreviations. All in capitals without accents.
ACCENTED, PLAIN = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŸ", "AAAAAACEEEEIIIINOOOOOOUUUUYY"
EMPTY_WORDS = (
    "SARL SAS SASU SA EURL SCP SELARL SELAS SELAFA SELASU SCI SNC SCM SCOP EI EIRL GIE AARPI SC SCCV STE SOC SOCIETE CIVILE PROF PROFESSIONNELLE LIMITEE ACTIONS RESPONSABILITE "
    "CABINET CAB ETUDE ETABLISSEMENTS ETS GROUPE GRP GROUP HOLDING MAISON AGENCE ENTREPRISE MONSIEUR MADAME MR MME MLLE MAITRE ME "
    "ET AND DE DU DES LA LE LES AU AUX EN SUR SOUS PAR POUR RECRUTEMENT RH RECRUTE SERVICE"
).split()
ACTIVITY_WORDS = {
    "expertise": "EXPERTISE EXPERTISES EXPERT EXPERTS EXP COMPTABLE COMPTABLES COMPTABILITE COMPTA COMPT FIDUCIAIRE FID FIDU AUDIT AUD",
    "avocat": "AVOCAT AVOCATS AVTS AVT AV JURIDIQUE JUR JURISTES",
    "notaire": "NOTAIRE NOTAIRES NOT NOTARIAL OFFICE",
    "patrimoine": "PATRIMOINE PATRIM PATRI GESTION GEST PRIVEE PRIV FINANCE FIN FINANCES COURTAGE COURT",
    "foncier": "PROMOTION PROMO IMMOBILIER IMMO IMMOBILIERE CONSTRUCTION CONSTR DEVELOPPEMENT DEV FONCIER FONC",
    "bureaux": "DOMICILIATION DOMICIL DOM BUREAUX BUR SERVICES SERV BUSINESS BUS CENTER CTR CENTRE",
    "emploi": "INTERIM INTERIMAIRE TRAVAIL TEMPORAIRE INSERTION PLACEMENT PORTAGE",
    "transport": "TRANSPORT TRANSPORTS LOGISTIQUE MESSAGERIE DEMENAGEMENT DEMENAGEMENTS TAXI TAXIS AMBULANCE AMBULANCES FRET",
    "table": "BOULANGERIE PATISSERIE BOUCHERIE CHARCUTERIE EPICERIE RESTAURATION RESTAURANT BRASSERIE PIZZERIA TRAITEUR HOTEL CAMPING",
    "soin": "CLINIQUE PHARMACIE HOPITAL HOSPITALIER EHPAD DENTAIRE MEDICAL INFIRMIER VETERINAIRE OPTIQUE OPTICIEN LABORATOIRE",
    "auto": "GARAGE CARROSSERIE AUTOMOBILE AUTOMOBILES PNEUS MOTOS",
    "metiers": "PLOMBERIE CHAUFFAGE ELECTRICITE MENUISERIE CHARPENTE MACONNERIE PEINTURE TOITURE COUVERTURE SERRURERIE METALLERIE PAYSAGE ESPACES",
    "commerce": "SUPERMARCHE LIBRAIRIE FLEURISTE BIJOUTERIE COIFFURE ESTHETIQUE PRESSING IMPRIMERIE MAGASIN",
    "public": "MAIRIE COMMUNE DEPARTEMENT PREFECTURE COMMUNAUTE METROPOLE SYNDICAT ECOLE LYCEE COLLEGE UNIVERSITE CRECHE",
    "": "CONSEIL CONSEILS CSL ASSOCIES ASSOCIE ASS ASSOC",
}
ACTIVITY = {w: k for k, ws in ACTIVITY_WORDS.items() for w in ws.split()}
_EMPTY = frozenset(EMPTY_WORDS)
#: Words of up to so many letters are indexed by what is left after deletes, longer ones by their parts.
LONGEST = 32
#: A long word is cut into so many parts: two slips, be they swaps across a cut, spoil at most four.
PARTS = 5


def normalized(name: Column) -> Column:
    """Capitals without accents, one space between words of letters and digits; '' for null or nothing left."""
    t = F.translate(F.upper(F.coalesce(name, F.lit(""))), ACCENTED, PLAIN)
    t = F.regexp_replace(F.replace(F.replace(t, F.lit("Œ"), F.lit("OE")), F.lit("Æ"), F.lit("AE")), r"\p{M}+", "")
    # dotted capitals are one word, elided articles and a leading 'M.' are none
    t = F.regexp_replace(t, r"(?<=\b\p{Lu})\.(?=\p{Lu}(\.|\b))", "")
    t = F.regexp_replace(t, r"\b[LD]['’]|^\s*M[. ]", " ")
    # a legal form that names a trade
    t = F.regexp_replace(t, r"\b(STE|SOC|SOCIETE)\s+(DE?\s+)?AVOCATS?\b", " ")
    return F.trim(F.regexp_replace(t, r"[^\p{Lu}\p{Lo}\p{N}]+", " "))


def is_core(word: Column) -> Column:
    """Whether a word can tell one firm from another."""
    return ~word.isin(*sorted(_EMPTY | set(ACTIVITY)))


# Spellings that sound alike, the second standing for the first.
SOUNDS = (("PH", "F"), ("KS", "X"), ("CK", "K"), ("QU", "K"), ("EAU", "O"), ("AU", "O"), ("Y", "I"))


def sound(word: Column) -> Column:
    """The word with spellings that sound alike made the same and doubled letters single."""
    for a, b in SOUNDS:
        word = F.replace(word, F.lit(a), F.lit(b))
    return F.regexp_replace(word, r"(\p{L})\1+", "$1")


def sounded(word: str) -> str:
    """The same of a Python string."""
    for a, b in SOUNDS:
        word = word.replace(a, b)
    return "".join(c for i, c in enumerate(word) if not i or c != word[i - 1] or not c.isalpha())


def activity_classes(words: Column) -> Column:
    """The kinds of activity that an array of words tells, as a sorted array."""
    kinds = F.create_map(*[F.lit(x) for w, k in ACTIVITY.items() if k for x in (w, k)])
    telling = F.filter(words, lambda w: w.isin(*[w for w, k in ACTIVITY.items() if k]))  # by hash: the map is searched from its start
    return F.array_sort(F.array_distinct(F.transform(telling, lambda w: kinds[w])))


def _deletes(word: str) -> set[str]:
    """The word and what is left of it after deleting up to one letter (4 to 6 letters) or two (7 and more)."""
    n = len(word)
    out = {word}
    if n >= 4:
        out.update([word[:i] + word[i + 1 :] for i in range(n)])
    if n >= 7:
        out.update([word[:i] + word[i + 1 : j] + word[j + 1 :] for i in range(n) for j in range(i + 1, n)])
    return out


def _part_keys(word: str) -> tuple[list[str], list[str]]:
    """(own, sought) keys of a long word: its PARTS parts, and what the parts of a word of nearly the same length that
    is two slips away may be, shifted by up to two letters. Of PARTS parts one is then left whole."""
    n = len(word)
    cut = lambda n, i: n * i // PARTS
    own = [f"{n} {i} {word[cut(n, i) : cut(n, i + 1)]}" for i in range(PARTS)]
    sought = {f"{m} {i} {word[a : a + cut(m, i + 1) - cut(m, i)]}" for m in range(n - 2, n + 3) for i in range(PARTS) for s in range(-2, 3) for a in [cut(m, i) + s] if a >= 0}
    return own, sorted(sought)


def _alike(a: Column, b: Column) -> Column:
    """Whether `likeness` may take one for the other for its letters: all within its distances, where a swap of two
    letters counts as one, and few besides."""
    n = F.least(F.length(a), F.length(b))
    d = lambda most: F.levenshtein(a, b, most)  # -1 beyond; in compiled code, as no function of an array is
    rest = lambda x, y: F.call_function("translate", x, y, F.lit(""))  # the letters of x that y has not
    odd = lambda x, y: F.length(rest(rest(x, y), F.left(rest(x, y), F.lit(1)))) > 0  # two or more such letters
    same = (F.length(a) == F.length(b)) & (rest(a, b) == "") & (rest(b, a) == "")
    swapped = same & (F.sort_array(F.split(a, "")) == F.sort_array(F.split(b, "")))
    short = (d(1) >= 0) | ((d(2) == 2) & swapped)
    long = (d(2) >= 0) | ((d(3) == 3) & ~odd(a, b) & ~odd(b, a)) | ((d(4) == 4) & swapped)
    return (a == b) | ((n >= 4) & F.when(n < 7, short).otherwise(long))


def _rests(words: DataFrame, sought: bool) -> DataFrame:
    """(rest, w): hashes of the keys under which each word is found, as spelled and as it sounds. words: (w, word), w
    a number of the word. sought: the side that looks for the other's parts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rests, sizes = [], []
            for word in b["word"]:
                keys: set[str] = set()
                for x in {word, sounded(word)}:
                    if len(x) <= LONGEST:
                        keys |= _deletes(x)
                    if len(x) > LONGEST - 3:
                        keys.update(_part_keys(x)[sought])
                rests += [xxhash.xxh3_64_intdigest(k) >> 1 for k in keys]
                sizes.append(len(keys))
            yield pd.DataFrame({"rest": np.array(rests, np.int64), "w": np.repeat(b["w"].to_numpy(), sizes)})

    return words.select("w", "word").mapInPandas(run, "rest long, w long")


def _near(typed: DataFrame, other: DataFrame | None = None) -> DataFrame:
    """Distinct (a, b, df): words a of typed and other words b of other within the distances of `likeness`, as spelled
    or as they sound, with b's df. Without other: of typed itself, both ways. What is shuffled are numbers of words;
    the words themselves join the pairs once, for the distance to decide."""
    number = F.xxhash64("word").alias("w")
    numbered = lambda t: t.select(number, "word", "df", sound(F.col("word")).alias("heard"))
    left, right = numbered(typed), numbered(typed if other is None else other)
    met = _rests(left, True).withColumnRenamed("w", "wa").join(_rests(right, False).withColumnRenamed("w", "wb"), "rest").where(F.col("wa") != F.col("wb"))
    if other is None:  # each pair once: of long words one side finds the other's parts, whichever it is
        met = met.select(F.least("wa", "wb").alias("wa"), F.greatest("wa", "wb").alias("wb"))
    met = met.select("wa", "wb").distinct()
    a, b = left.select(F.col("w").alias("wa"), F.col("word").alias("a"), F.col("heard").alias("ha"), F.col("df").alias("df_a")), right.select(F.col("w").alias("wb"), F.col("word").alias("b"), F.col("heard").alias("hb"), F.col("df").alias("df_b"))
    met = met.join(a, "wa").join(b, "wb")
    otherwise_heard = (F.col("ha") != F.col("a")) | (F.col("hb") != F.col("b"))
    met = met.where(_alike(F.col("a"), F.col("b")) | (otherwise_heard & _alike(F.col("ha"), F.col("hb"))))
    one = met.select("a", "b", F.col("df_b").alias("df"))
    return one if other is not None else one.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("df_a").alias("df")))


def word_index(words: DataFrame, trusted_only: bool = False) -> DataFrame:
    """(word, df, trusted, keys): under which words a word is looked up, keys: array<struct<word, df>>, itself first.
    words: (word, df, trusted), one row a word.

    Every word also stands for all words within the distances that `likeness` allows, whatever else lies near it, so
    what the index knows does not hang on the size of the vocabulary; if trusted_only, untrusted words stand for the
    trusted words near them, and trusted ones for themselves. Symmetric delete: two words are near if deleting letters
    from each, as spelled or as they sound, can give the same; such pairs meet by an equi-join on what is left, and
    Levenshtein's distance decides. Words of more than LONGEST letters meet by their parts instead."""
    words = materialize(words, "vocabulary")
    long = words.where((F.length("word") >= 4) & ~F.col("word").rlike("[0-9]"))
    near = _near(long.where(~F.col("trusted")), long.where("trusted")) if trusted_only else _near(long)
    more = near.groupBy(F.col("a").alias("word")).agg(F.array_sort(F.collect_list(F.struct(F.col("b").alias("word"), "df"))).alias("more"))
    own = F.array(F.struct("word", "df"))
    return words.join(more, "word", "left").select("word", "df", "trusted", F.concat(own, F.coalesce("more", F.slice(own, 1, 0))).alias("keys"))


def edit(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours as one; most + 1 if it is greater than most."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], older[j - 2] + 1)
        if min(row) > most:
            return most + 1
    return row[-1]


@lru_cache(1 << 16)
def _heard(word: str) -> str:
    return sounded(word)


@lru_cache(1 << 16)
def _letters(word: str) -> int:
    """Which letters a word has, as bits."""
    m = 0
    for c in word:
        m |= 1 << (ord(c) & 63)
    return m


def likeness(a: str, b: str, both_trusted: bool = False) -> float:
    """How well one word can be another: the same 1; an initial or an abbreviation 0.8; a slip or two 0.7 to 0.95."""
    if a == b:
        return 1.0
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    if len(s) == 1:
        return 0.8 if t[0] == s else 0.0
    if both_trusted:
        return 0.0
    return _slips(s, t)


@lru_cache(1 << 17)
def _slips(s: str, t: str) -> float:
    heard = _heard(s), _heard(t)
    if heard[0] == heard[1]:
        return 0.97
    share = 0.0
    for x, y in ((s, t), heard):
        n, m = len(x), len(y)
        most = 0 if min(n, m) < 4 else 1 if min(n, m) < 7 else 2
        # each slip brings or takes at most two letters
        if most and abs(n - m) <= most and (_letters(x) ^ _letters(y)).bit_count() <= 2 * most and (d := edit(x, y, most)) <= most:
            share = max(share, 1 - 0.8 * d / max(n, m))
    if share:
        return share
    return 0.8 if len(s) >= 3 and t.startswith(s) else 0.0


def _added(values: Iterable[float]) -> float:
    """Their sum, one after the other: sum() rounds Python's floats otherwise than NumPy's."""
    total = 0.0
    for x in values:
        total += x
    return total


def assign(like: list[list[float]], gain: list[list[float]]) -> tuple[float, list[tuple[int, int]]]:
    """The assignment of rows to columns with the greatest sum of gains, exactly, by the shortest augmenting path
    method (Hungarian). Only pairs with a likeness are reported."""
    n, m = len(gain), len(gain[0]) if gain else 0
    if not n or not m:
        return 0.0, []
    if n > m:
        total, pairs = assign([list(r) for r in zip(*like)], [list(r) for r in zip(*gain)])
        return total, [(j, i) for i, j in pairs]
    if n == 1:
        j = max(range(m), key=lambda k: gain[0][k])
        return (gain[0][j], [(0, j)]) if like[0][j] > 0 else (0.0, [])
    if n == m == 2:
        straight, crossed = gain[0][0] + gain[1][1], gain[0][1] + gain[1][0]
        pairs = [(0, 0), (1, 1)] if straight >= crossed else [(0, 1), (1, 0)]
        pairs = [(i, j) for i, j in pairs if like[i][j] > 0]
        return _added(gain[i][j] for i, j in pairs), pairs
    inf = float("inf")
    u, v, match = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = [inf] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while True:
            used[j0] = True
            i0, delta, j1 = match[j0], inf, 0
            for j in range(1, m + 1):
                if not used[j]:
                    c = -gain[i0 - 1][j - 1] - u[i0] - v[j]
                    if c < least[j]:
                        least[j], way[j] = c, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(m + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
            if not match[j0]:
                break
        while j0:
            j1 = way[j0]
            match[j0] = match[j1]
            j0 = j1
    pairs = [(match[j] - 1, j - 1) for j in range(1, m + 1) if match[j] and like[match[j] - 1][j - 1] > 0]
    return _added(gain[i][j] for i, j in pairs), pairs


#: A name for alignment: its core words, their weights (rarity) and whether each is of an official spelling; its kinds of activity.
def align(a: tuple[list[str], list[float], list[bool]], b: tuple[list[str], list[float], list[bool]], doubt: float | None = None) -> tuple[float, bool, bool]:
    """(share of the lighter name's weight that finds a counterpart in the other, whether the order is kept, whether
    an initial stands for a word). At least two words, or all of a name, must be matched. Two different words of
    official spellings are different names, or, with a doubt, as alike as any less that doubt."""
    (x, wx, tx), (y, wy, ty) = a, b
    least = min(len(x), len(y))
    initials = any(len(w) == 1 for w in x) or any(len(w) == 1 for w in y)
    like = []
    for p, t in zip(x, tx):
        row = []
        for q, u in zip(y, ty):
            if p == q:
                row.append(1.0)
            elif not (t and u) or len(p) == 1 or len(q) == 1:
                row.append(likeness(p, q, t and u))
            else:
                row.append(0.0 if doubt is None else max(likeness(p, q) - doubt, 0.0))
        like.append(row)
    if least > 1 and (sum(map(any, like)) < 2 or sum(map(any, zip(*like))) < 2):  # no two words have counterparts of their own
        return 0.0, True, False
    weigh = lambda i, j: max(wx[i], wy[j]) if min(len(x[i]), len(y[j])) == 1 else (wx[i] + wy[j]) / 2
    gain = [[v * weigh(i, j) if v else 0.0 for j, v in enumerate(r)] for i, r in enumerate(like)]
    total, pairs = assign(like, gain)
    if not pairs or (len(pairs) < 2 and least > 1):
        return 0.0, True, False
    if initials:  # they weigh what their counterparts do
        whole = lambda words, w, side: _added(max(w[k], next((wy[j] if side == 0 else wx[i] for i, j in pairs if (i, j)[side] == k), 0.0)) if len(words[k]) == 1 else w[k] for k in range(len(words)))
        lighter = min(whole(x, wx, 0), whole(y, wy, 1))
    else:
        lighter = min(_added(wx), _added(wy))
    share = total / max(lighter, 1e-9)
    at = [j for _, j in sorted(pairs)]
    kept = all(p < q for p, q in pairwise(at)) if len(at) > 1 else True
    thin = initials and any(len(x[i]) != len(y[j]) and min(len(x[i]), len(y[j])) == 1 for i, j in pairs)
    return min(share, 1.0), kept, thin


def activities(words: list[str]) -> set[str]:
    """The kinds of activity that the words of a name tell."""
    return {ACTIVITY[w] for w in words if ACTIVITY.get(w)}
