"""Problem 7: template residue, filler, error pages and script notices in place of content.

Units are message lines, and the sentences of longer lines, with digits masked. Trusted seeds are units that match the fixed
patterns below, hold an unfilled slot or are filler Latin. From the message seeds the labels spread through connected
components: SimHashes (64 bits over character trigrams) are kept in TABLES partitioned tables of BITS bits; the frontier is
put into them, each unit is looked up in all, what meets is verified by Hamming distance and by text similarity, and new
residue units form the next frontier until none is new. Seeds by slot or filler do not spread: the same sentence with its slot
filled is content.

Scale: a record's units leave the reading pass as hashes, each distinct unit of a task's stream once with its SimHash; texts
are read again only for units that meet the tables. The frontier, which variants of messages make up, is sent to the units
in blocks of BLOCK rows, so its size does not matter to memory; no pairs of ordinary units are formed and nothing else is
collected.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans import checked_broadcast
from millrace.session import cut_lineage
from millrace.sources import table

#: Longer lines are judged sentence by sentence.
MAX_LINE = 240
#: SimHash tables: window t holds BITS bits from bit 64 t / TABLES on.
TABLES, BITS = 16, 12
#: Bits that near-duplicates may differ in before their texts are compared, the similarity that texts need, and the characters.
HAMMING, SIMILAR, SPREADS = 14, 0.8, 20
BLOCK = 20_000
#: Distinct units that a worker remembers; beyond, it starts a new store (units are then given again, which changes nothing).
STORE = 300_000

# The notations of unfilled slots.
SLOT = (
    r"\{\{\s*[\w.]+\s*\}\}|\{%-?\s*[\w.]+\s*-?%\}|[$#]\{\s*[\w.]+\s*\}|\[\[\s*[\w.]+\s*\]\]|%\([\w.]+\)s|(?<![A-Za-z0-9%])%[A-Za-z][A-Za-z_.]+%|@@[\w.]+@@"
    r"|(?<![A-Za-z0-9_])__[a-z][a-z.]*(?:_[a-z.]+)*__(?![A-Za-z0-9_])|<%=?\s*[\w.]+\s*%>|<[a-z]+[._][a-z._]+>|<(?:category|company|price|title|name|author|date|city|email)>"
    r"|\[(?:INSERT|Insert|insert|YOUR|Your|your)\b[^\]\n]{0,60}\]|(?<![A-Za-z0-9_])(?:TODO|FIXME|TBD): ?[\w.]+|(?<![A-Za-z0-9_])X{3,}(?![A-Za-z0-9_])"
)
# Words of a sentence that speaks of a slot rather than leaving it unfilled.
SPEAKS = r"\b(?:templates?|tags?|placeholders?|shell|expands?|renderers?|replaced by|variables?|syntax|interpolat\w+|escap\w+|literal(?:ly)?|notation)\b"
# Openings of lines of program code.
CODE = r"^\s*(?:def |class |import |from \w+ import|return |echo |SELECT |INSERT INTO|UPDATE |CREATE |const |let |var |function |if ?\(|for ?\(|while ?\(|print\(|render\(|\w+\(['\"]|\$ |>>> |#include|//|/\*|</?\w+[^>]*>\s*$|[\w.]+ ?= ?[\w\[({'\"])"
# Words of filler Latin.
LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo "
    "consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
# Whole lines that are messages of a server, a browser check, a script notice or demo text (digits masked as 0).
MESSAGES = (
    r"(?:error )?0(?: ?[-:|–] ?| )(?:page |file )?(?:not found|forbidden|bad gateway|internal server error|service (?:temporarily )?unavailable|gateway time-?out|gone|unauthorized|too many requests).*",
    r"(?:http )?(?:status|error)(?: code)? 0\b.*", r"(?:page|file|document|site) not found\.?", r"(?:internal server error|bad gateway|access denied|forbidden|service (?:temporarily )?unavailable|gateway time-?out)\.?",
    r"the (?:page|file|document|item|content|url) you(?: (?:have|are|were))? (?:requested|followed|looking for|tried).*", r"you (?:do not|don't) have (?:permission|access) to .*", r"your session (?:has|is) expired.*", r"too many requests\b.*",
    r"our servers? (?:is|are) (?:under maintenance|down|busy|overloaded).*", r"we(?:'|’)?(?:re| are) down (?:for|at).*", r"(?:oops|whoops|uh-oh)\b.{0,40}(?:wrong|error|broke).*", r"something went wrong\b.*", r"the server (?:met|encountered|is unable|could not|did not)\b.*",
    r"this (?:item|page|content|article|video|product) is no longer available.*", r"nothing to see here\b.*", r"(?:sorry, )?we (?:can't|can’t|cannot|couldn't|could not) find .* anywhere.*", r"(?:fatal|parse|runtime|syntax) error:.*", r"traceback \(most recent call last\).*", r"[a-z]*(?:error|exception): .*(?:'|\"|\bat\b|\bline\b).*",
    r"(?:undefined|null|nan|none|true|false|\[object object\])(?: (?:undefined|null|nan|none|\[object object\]))*", r"loading(?:\.\.\.|…)?", r"upstream .* did not answer.*", r"database (?:connection|error|query|server)\b.*(?:refused|failed|error|lost|unavailable).*", r"gone\.?", r"the (?:listing|page|item|post|article|file|document|account) .*was (?:removed|deleted|archived|moved|renamed)\b.*",
    r"(?:warning|notice|deprecated): .*(?: on line 0|failed to|undefined).*", r".{0,80}\bcannot run without (?:client-side code|javascript|scripts?|scripting).*",
    r"(?:please )?(?:enable|activate|turn on|switch on|allow) (?:javascript|scripts?|scripting|cookies)\b.*", r"(?:you need|you have|it is necessary) to (?:enable|activate|turn on|switch on) (?:javascript|scripts?|scripting)\b.*", r"(?:this|our) (?:site|page|app|website) (?:requires|needs|relies on) (?:javascript|scripts?|scripting)\b.*", r"javascript is (?:not available|disabled|required|turned off|switched off).*",
    r"it looks like (?:javascript|scripts?|scripting) is .*", r"your browser (?:is out of date|does not support|doesn't support|blocks|has scripts?).*", r"(?:if nothing happens, )?your browser is blocking .*", r"switch to a supported browser.*", r"(?:please )?(?:verify|confirm|prove) (?:that )?you are (?:a )?(?:human|person|not a robot).*",
    r"press and hold to confirm .*", r"(?:one|just a) moment,? .*(?:secure|checking|connection|verif).*", r"checking (?:your|the) (?:browser|connection)\b.*", r"this may take a few seconds.*",
    r"this is (?:a|an) (?:sample|example|placeholder|demo) (?:paragraph|page|text|post|sentence)\b.*", r"hello,? world!? this is your first post.*", r"your (?:text|content|title|heading) (?:goes )?here\.?", r"placeholder (?:copy|text|content)\b.*", r"image caption (?:to be supplied|goes here|here)\b.*", r"heading \w+ of the demo theme", r"write a short description of your .*",
    r"add your .* (?:in|with|using) the editor\.?", r"sample page", r"(?:click here to edit|edit or delete) this (?:text|post).*", r"lorem ipsum\b.{0,30}",
    r"fehler 0: .*", r"seite nicht gefunden\.?", r"die (?:gewünschte|angeforderte|gesuchte) seite .*(?:nicht|mehr).*", r"bitte aktivieren sie (?:javascript|skripte).*", r"ihr browser (?:führt|unterstützt|blockiert) .*skript.*", r"(?:der|dieser) (?:dienst|server) ist (?:vorübergehend|derzeit) nicht .*",
    r"erreur (?:interne|0|du serveur)\b.*", r"page (?:introuvable|non trouvée)\.?", r"(?:le contenu|la page) (?:demandée?|recherchée?) n(?:'|’)(?:existe|est) .*", r"veuillez activer (?:javascript|les scripts).*",
    r"error (?:interno|0|del servidor)\b.*", r"página no encontrada\.?", r"(?:el contenido|la página) que (?:busca|solicitó|ha solicitado) .*", r"activ[ea] (?:javascript|los scripts).*", r"(?:habilite|active) javascript.*",
    r"erro (?:interno|0|do servidor)\b.*", r"página não encontrada\.?", r"(?:o conteúdo|a página) que (?:procura|você procura|solicitou) .*", r"ative o (?:javascript|script).*", r"a página (?:solicitada|pedida) .*(?:não|mais).*",
    r"errore (?:interno|0|del server)\b.*", r"pagina non trovata\.?", r"(?:il contenuto|la pagina) (?:richiest[oa]|che cerchi|che stai cercando|cercat[oa]) .*", r"attiva(?:re)? (?:javascript|gli script).*", r"abilita(?:re)? javascript.*",
    r"ошибка 0\b.*", r"страница не найдена\.?", r"(?:запрошенная|запрашиваемая) страница .*", r"включите (?:выполнение сценариев|javascript|скрипты|сценарии).*", r"(?:сервер|сервис) временно недоступен.*",
    r"您(?:访问|请求|查找)的(?:页面|内容).*(?:不存在|已删除|无法).*", r"(?:页面|网页)(?:未找到|不存在).*", r"请(?:启用|打开|开启)(?:脚本|javascript).*", r"(?:错误 ?0|服务器(?:错误|暂时|繁忙)|服务暂时).*",
    r"(?:お探しの)?(?:ページ|記事)(?:が|は)(?:見つかりません|存在しません|ありません).*", r".{0,12}(?:javascript|スクリプト)を(?:有効|オン).*", r"(?:エラー ?0|サーバー(?:エラー|が|は)).*", r"お探しのページ.*",
    r"(?:الصفحة|لم يتم العثور|تعذر العثور).{0,40}(?:غير موجودة|الصفحة|متاحة).*", r"(?:يرجى|الرجاء) تفعيل (?:جافا ?سكريبت|javascript|البرامج النصية).*", r"خطأ 0\b.*",
    r"(?:पृष्ठ|पेज) (?:नहीं मिला|उपलब्ध नहीं).*", r"(?:कृपया )?(?:जावास्क्रिप्ट|स्क्रिप्ट|javascript) (?:चालू|सक्षम|सक्रिय).*", r"त्रुटि 0\b.*",
    r"ไม่พบหน้า.*", r"(?:โปรด|กรุณา)(?:เปิด|เปิดใช้(?:งาน)?) ?(?:จาวาสคริปต์|สคริปต์|javascript).*", r"(?:ข้อผิดพลาด|เกิดข้อผิดพลาด).*",
)

_SLOT = re.compile(SLOT)
_SPEAKS = re.compile(SPEAKS, re.I)
_CODE = re.compile(CODE)
#: Asked of lower-case text, which lets most alternatives fail at their first character.
_MESSAGE = re.compile("|".join(f"(?:{m})" for m in MESSAGES))
_LONG_LATIN = frozenset(w for w in LATIN if len(w) > 4)
_WORDS = re.compile(r"[^\W\d_]+")
def _unfilled(line: str) -> bool:
    """A slot in a sentence that does not speak of slots."""
    if _CODE.search(line) and not _SLOT.match(line.strip()):
        return False
    masked = _SLOT.sub("\ue000", line)
    return any("\ue000" in s and not _SPEAKS.search(s) for s in re.split(r"(?<=[.!?。！？])\s*", masked))


def _filler(line: str) -> bool:
    """At least four words, three fifths of them filler Latin, and two of its long words."""
    w = _WORDS.findall(line.lower())
    if len(w) < 4 or _LONG_LATIN.isdisjoint(w):
        return False
    return sum(x in LATIN for x in w) >= 0.6 * len(w) and sum(x in _LONG_LATIN for x in w) >= 2


_SLOT_SIGNS = re.compile(r"[{%\[<]|@@|__|TODO|FIXME|TBD|XXX")
_SENTENCE = re.compile(r"(?<=[.!?।])\s+|(?<=[。！？])")
_DIGITS = re.compile(r"\d+")


def _kind(s: str) -> int:
    """Of a trimmed unit with digits masked: 1 a message, 2 an unfilled slot or filler, 0 none of these."""
    if _SLOT_SIGNS.search(s) and _SLOT.search(s) and _unfilled(s):
        return 2
    if _filler(s):
        return 2
    return int(len(s) <= MAX_LINE and bool(_MESSAGE.fullmatch(s.lower())))


def units_of(line: str) -> list[str]:
    """A line, or the sentences of a long one, trimmed; none for a blank line."""
    s = line.strip()
    return [s] if len(s) <= MAX_LINE and s else [x for x in map(str.strip, _SENTENCE.split(s)) if x]


def is_residue(line: str) -> bool:
    """The trusted test of one line."""
    return any(_kind(_DIGITS.sub("0", u)) for u in units_of(line))


#: The bits of a byte in the bytes of a 64-bit number, so that up to 255 bytes are counted by bit in one sum.
_LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], dtype=np.uint64)


def simhash64(texts: list[str]) -> np.ndarray:
    """64-bit SimHash over character trigrams of lower-case text, vectorised over the batch."""
    out = np.zeros(len(texts), dtype=np.uint64)
    for at in range(0, len(texts), 4096):
        part = [f"  {t.lower()} " for t in texts[at : at + 4096]]
        cp = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        n = np.array([len(t) - 2 for t in part])
        ends = np.cumsum(n)
        first = ends - n
        pos = np.arange(ends[-1]) + np.repeat(2 * np.arange(len(part)), n)
        h = cp[pos] * np.uint64(0x9E3779B97F4A7C15) ^ cp[pos + 1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ cp[pos + 2] * np.uint64(0x165667B19E3779F9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        # sums run over pieces of at most 255 trigrams of one text
        pieces = -(-n // 255)
        cuts = np.repeat(first, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        votes = np.empty((len(part), 64), np.int64)
        for byte in range(8):
            sums = np.add.reduceat(_LANES[(h >> np.uint64(8 * byte)).astype(np.uint8)], cuts).view(np.uint8).reshape(-1, 8)
            votes[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(sums.astype(np.int64), np.cumsum(pieces) - pieces, axis=0)
        out[at : at + len(part)] = np.packbits((votes * 2 > n[:, None]).astype(np.uint8), axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _hash(text: str) -> int:
    import xxhash

    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >= 1 << 63 else h


def _record_units(text, title, code) -> list[str]:
    """Masked units of a record's text and title, without shown code."""
    shown = {x for c in code or () for x in (c or "").split("\n")}
    return [_DIGITS.sub("0", u) for line in ((text or "").split("\n") + [title or ""]) if line not in shown for u in units_of(line)]


_UNITS = "id long, own array<long>, u array<long>, sim array<long>, kind array<byte>, size array<int>"


def _judge(batches):
    """Per record the hashes of its units, and of the units new to this worker their hash, SimHash and kind."""
    seen: dict[str, int] = {}
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            b = whole.slice(at, 500)
            own, new, texts = [], [], []
            if len(seen) > STORE:
                seen = {}
            for row in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                hs, fresh = [], []
                for u in _record_units(*row):
                    h = seen.get(u)
                    if h is None:
                        h = seen[u] = _hash(u)
                        fresh.append(h)
                        texts.append(u)
                    hs.append(h)
                own.append(hs)
                new.append(fresh)
            sims, kinds = simhash64(texts).view(np.int64).tolist() if texts else [], [_kind(u) for u in texts]
            cuts = np.cumsum([0, *map(len, new)]).tolist()
            parts = lambda xs: [xs[i:j] for i, j in zip(cuts, cuts[1:])]  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.list_(t)) for x, t in ((own, pa.int64()), (new, pa.int64()), (parts(sims), pa.int64()), (parts(kinds), pa.int8()), (parts([len(u) for u in texts]), pa.int32())))], ["id", "own", "u", "sim", "kind", "size"])


def _windows(sims: np.ndarray):
    """For each table the bits of its window."""
    for t in range(TABLES):
        r = np.uint64(64 * t // TABLES)
        yield ((sims >> r) | (sims << ((np.uint64(64) - r) % np.uint64(64)))) & np.uint64((1 << BITS) - 1)


def _meet(frontier):
    """mapInArrow over (id, u, sim, size): units that meet a frontier row (v, vsim, vsize) in a table, differ in HAMMING bits at most
    and are long enough for similar texts."""

    def run(batches):
        v, vsim, vsize = (np.frombuffer(x, np.int64) for x in frontier.value)
        vsim = vsim.view(np.uint64)
        tables = []
        for w in _windows(vsim):
            held = np.zeros(1 << BITS, bool)
            held[w] = True
            tables.append(held)
        for b in batches:
            ids, us, sims, sizes = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4))
            sims = sims.view(np.uint64)
            hit = np.zeros(len(sims), bool)
            for held, w in zip(tables, _windows(sims), strict=True):
                hit |= held[w]
            ids, us, sims, sizes = ids[hit], us[hit], sims[hit], sizes[hit]
            step = max(1, 4_000_000 // max(1, len(v)))
            for at in range(0, len(us), step):
                near = np.bitwise_count(sims[at : at + step, None] ^ vsim[None, :]) <= HAMMING
                k, m = np.nonzero(near)
                a, c = sizes[at + k], vsize[m]
                fits = np.minimum(a, c) >= SIMILAR * np.maximum(a, c)
                k, m = k[fits], m[fits]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids[at + k], us[at + k], v[m])], ["id", "u", "v"])

    return run


def _texts(wanted):
    """mapInArrow over records: the text of each wanted unit (hashes)."""

    def run(batches):
        want = set(wanted.value)
        for b in batches:
            rows = {(h, u) for row in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True) for u in _record_units(*row) if (h := _hash(u)) in want}
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["u", "text"])

    return run


def _blocks(df: DataFrame, size: int, *cols: str):
    """The rows of a frontier in blocks of about ``size`` rows, as lists."""
    df = cut_lineage(df)
    n = max(1, -(-df.count() // size))
    for k in range(n):
        yield (df if n == 1 else df.filter(F.pmod(F.xxhash64("u"), F.lit(n)) == k)).select(*cols).collect()


def spread(docs: DataFrame, units: DataFrame) -> DataFrame:
    """(u, round) of residue units: seeds in round 0, then those that propagation reaches. docs as for ``residue_records``;
    units: (id, u, sim, kind, size), id being a record that holds the unit."""
    sc = docs.sparkSession.sparkContext
    long = F.col("size") >= SPREADS
    found = cut_lineage(units.filter("kind > 0").groupBy("u").agg(F.lit(0).alias("round")))
    frontier = cut_lineage(units.filter((F.col("kind") == 1) & long).groupBy("u").agg(F.min("id").alias("id"), F.min("sim").alias("sim"), F.min("size").alias("size")))
    rest = units.filter((F.col("kind") == 0) & long).select("id", "u", "sim", "size")
    rounds = 0
    while not frontier.isEmpty():
        rounds += 1
        near = None
        for rows in _blocks(frontier, BLOCK, "u", "sim", "size"):
            shared = sc.broadcast(tuple(np.array([r[k] for r in rows], np.int64).tobytes() for k in range(3)))
            got = rest.mapInArrow(_meet(shared), "id long, u long, v long")
            near = got if near is None else near.unionByName(got)
        near = cut_lineage(near.groupBy("u", "v").agg(F.min("id").alias("id")).join(found.select("u"), "u", "left_anti"))
        # the texts of both sides, read from records that hold them
        holders = near.select("id", "u").unionByName(near.select(F.col("v").alias("u")).distinct().join(frontier.select("id", "u"), "u").select("id", "u"))
        held = docs.join(checked_broadcast(holders.select("id").distinct()), "id", "left_semi").select("id", "text", "title", "code")
        texts = None
        for rows in _blocks(holders.select("u").distinct(), 20 * BLOCK, "u"):
            got = held.mapInArrow(_texts(sc.broadcast([r.u for r in rows])), "u long, text string")
            texts = got if texts is None else texts.unionByName(got)
        texts = cut_lineage(texts.dropDuplicates(["u"]))
        pair = near.join(texts.select("u", F.col("text").alias("tu")), "u").join(texts.select(F.col("u").alias("v"), F.col("text").alias("tv")), "v")
        most = F.greatest(F.length("tu"), F.length("tv"))
        same = pair.filter(F.levenshtein("tu", "tv") <= (1 - SIMILAR) * most)
        new = same.groupBy("u").agg(F.min("id").alias("id"))
        frontier = cut_lineage(new.join(units.groupBy("u").agg(F.min("sim").alias("sim"), F.min("size").alias("size")), "u").select("u", "id", "sim", "size"))
        found = cut_lineage(found.unionByName(frontier.select("u", F.lit(rounds).alias("round"))))
    return found


def judged_units(docs: DataFrame) -> DataFrame:
    """_UNITS of docs (id, text, title, code array<string>), as a table."""
    return cut_lineage(docs.select("id", "text", "title", "code").mapInArrow(_judge, _UNITS))


def _flat(judged: DataFrame) -> DataFrame:
    return judged.select("id", F.explode(F.arrays_zip("u", "sim", "kind", "size")).alias("z")).select("id", "z.u", "z.sim", "z.kind", "z.size")


def residue_records(docs: DataFrame) -> DataFrame:
    """Ids of docs (id, text, title, code array<string>) whose text or title holds residue outside of shown code.

    Null or empty text and title hold none; repeated rows give their id once; very long texts are read whole."""
    judged = judged_units(docs)
    bad = checked_broadcast(spread(docs, _flat(judged)).select("u"))
    return judged.select("id", F.explode("own").alias("u")).join(bad, "u", "left_semi").select("id").distinct()


def _docs(spark, d: str) -> DataFrame:
    return table(spark, d, "extracted_content").select(F.col("extract_id").alias("id"), "text", "title", F.col("code_blocks.content").alias("code"))


def p7_found(spark, d: str) -> DataFrame:
    return residue_records(_docs(spark, d)).withColumnRenamed("id", "extract_id")


def p7_rounds(spark, d: str) -> DataFrame:
    """How many distinct units are residue by their own pattern (round 0) and by propagation (each later round)."""
    docs = _docs(spark, d)
    return spread(docs, _flat(judged_units(docs))).groupBy("round").agg(F.count_distinct("u").alias("units"))


QUERIES = {"p7_found": p7_found, "p7_rounds": p7_rounds}
ORACLE: dict[str, str] = {}
