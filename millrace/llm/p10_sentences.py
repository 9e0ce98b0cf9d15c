"""Problem 10: sentence units of documents in many languages and scripts, all in SQL expressions.

Marks that end no sentence (decimals, addresses, initials, abbreviations, marks inside quotations and brackets) are
masked by private-use characters, one for one, so that positions hold; the masked text is cut at blank lines, list items
and script-specific terminators; positions come from the lengths of the pieces, and the text itself is read from the
original by position, which restores every masked mark. There is no shuffle: each document is worked on in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources import table

# Private-use placeholders.
DOT, IN_QUOTE, QUOTE_END, IN_BRACKET, BRACKET_END, CUT, SAID_END = "", "", "", "", "", "", ""
TERMINATORS = ".!?。！？…।؟｡"
#: Items whose running sums are made together.
CHUNK = 256
#: White space of Unicode, as trimmed from the ends of units.
BLANKS = "".join(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

# Abbreviations that never end a sentence while text follows.
NEVER = (
    "Dr Drs Prof Mr Mrs Ms Mx St Sr Sra Srta Jr Rev Hon Capt Col Gen Lt Maj Sgt Cpl Sen Rep Gov Pres Dept dept Univ Mt Ft Av Ave Blvd Rd av no No Nos no nos Nr nr Art art Abs Abb Tab Fig Figs fig figs Sec Secs sec Eq Eqs eq Ch ch Vol vol Vols "
    "pp pag pág págs pagg cf cfr Cf Vgl vgl bzw ca Ca inkl exkl zzgl evtl ggf Hr Hrn Fr Frl Dra Dña Ud Uds EE approx esp viz vs ed eds est max min oz lb ft tel Tel ext incl resp "
    "Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec dott Dott dottssa sig Sig sigg prof avv ing arch Mme Mlle MM Mgr boul тыс млн млрд руб коп ул пр пер обл им см ср напр стр рис табл гр тел д-р проф акад доц डॉ श्री वि सं प्रो"
).split()
# Abbreviations that may end a sentence; masked only where the next word goes on in lower case.
MAY_END = "Inc Ltd Co Corp Bros al etc usw uvm ecc др пр п".split()

def _trie(words: set[str]) -> str:
    """Alternation of the words by common beginnings, so that a failed attempt costs few comparisons."""
    heads: dict[str, set[str]] = {}
    for w in words:
        heads.setdefault(w[:1], set()).add(w[1:])
    parts = []
    for h in sorted(heads):
        rest = heads[h] - {""}
        parts.append(h + (_trie(rest) + ("?" if "" in heads[h] else "") if rest else ""))
    return "(?:" + "|".join(parts) + ")"


_NEVER = _trie({*NEVER, *(w.lower() for w in NEVER)})
_MAY_END = _trie({*MAY_END, *(w.lower() for w in MAY_END)} - {"usw", "ecc"} | {"etc"})
_NOT_IN_WORD = r"(?<![\p{L}\p{N}\p{M}.\-" + DOT + "])"
#: Text goes on in the same paragraph.
_GOES_ON = r"(?=[ \t\u00a0]*\n?[ \t\u00a0]*[^\s])"
#: One pass over the dots: inside numbers, addresses and file names; after abbreviations, initials, other single letters and list numbers.
MASK = (
    r"\.(?:(?<=[\p{L}\p{N}]\.)(?=[\p{Ll}\p{N}])"
    rf"|(?<={_NOT_IN_WORD}{_NEVER}\.){_GOES_ON}"
    rf"|(?<={_NOT_IN_WORD}{_MAY_END}\.)(?=[ \t]*\n?[ \t]*(?:[\p{{Ll}}\p{{N}}&,;]|(?:Ltd|Inc)\b))"
    rf"|(?<={_NOT_IN_WORD}\p{{L}}\p{{M}}?\.){_GOES_ON}"
    r"|(?<=(?:^|\n)[ \t]{0,8}\d{1,3}\.)(?=[ \t]))"
)
#: Before these a new block begins: after a blank line, and at list items.
_BLOCK = r"\n(?=[ \t]*(?:[-*•·–‣▪]|\d{1,3}[" + DOT + r".)])[ \t]|[ \t\u00a0]*\n)"
_REFS = r"(?:\[\d{1,4}\])*"
#: Ends of sentences in masked text; group 0 stays and a cut follows it. Each begins with the mark itself.
_COMMON = (
    rf"|[。！？｡]+{_REFS}(?![、，,{SAID_END}{QUOTE_END}])"
    rf"|[.!?](?<=[\p{{Ll}}\p{{N}}][.!?]){_REFS}(?=[\p{{Lu}}¿¡]\p{{L}})"
    r"|[.؟](?<=[\u0600-\u06ff][.؟])(?=[\u0600-\u06ff]{2})|।(?=[\u0900-\u097f])"
    rf"|{SAID_END}+\"{_REFS}(?=\s*[^\s\p{{Ll}},;、，と—–.])"
)
#: The characters that a cut may follow; looked at first, so that other positions cost one comparison.
_MARK = rf"(?=[.!?…।؟。！？｡{QUOTE_END}{BRACKET_END}{SAID_END}])"
_CASED = _MARK + rf"(?:[.!?…।؟]+[\"(]?{_REFS}(?=\s+[^\s\p{{Ll}},;])|{QUOTE_END}+\"{_REFS}(?=\s+[\p{{Lu}}\"¿¡\[(\d])|{BRACKET_END}+\({_REFS}(?=\s+[^\s\p{{Ll}},;])" + _COMMON + ")"
_LOWER = _MARK + rf"(?:[!?।؟]+[\"(]?{_REFS}(?=\s+[^\s,;])|\.(?<![.]\.)[\"(]?{_REFS}(?=\s+[^\s,;])|{BRACKET_END}+\({_REFS}(?=\s+[^\s,;])" + _COMMON + ")"
#: Thai parts its sentences by spaces.
_THAI = r"[\u0e00-\u0e7f0-9\"(.!?…](?=\s+[\"(]?[\u0e00-\u0e7f])"


def _hide(part: Column, inner: str, final: Column) -> Column:
    """Terminators of a quoted or bracketed part masked by ``inner``; those at its very end by ``final``."""
    return F.regexp_replace(F.translate(part, TERMINATORS, inner * len(TERMINATORS)), F.lit(inner + "(?=" + inner + r"*\s*$)"), final)


def _inside(block: Column, mark: str, inner: str, final: str, said: str | None) -> Column:
    """Every second part between two ``mark``s of a block hidden; a block with an odd number of marks stays as it is.

    With ``said``, a part introduced by a colon or comma ends its sentence and gets ``said`` instead of ``final``."""
    parts = F.split(block, "[" + mark + "]")
    pairs = F.zip_with(parts, F.concat(F.array(F.lit("")), parts), lambda x, before: F.struct(x.alias("x"), before.alias("before")))  # one longer: cut off below
    end = lambda z: F.when(z["before"].rlike(r"[:：,，]\s*$"), F.lit(said)).otherwise(F.lit(final)) if said else F.lit(final)
    done = F.array_join(F.transform(F.slice(pairs, F.lit(1), F.size(parts)), lambda z, i: F.when(i % 2 == 1, _hide(z["x"], inner, end(z))).otherwise(z["x"])), mark)
    marks = F.length(block) - F.length(F.translate(block, mark, ""))
    return F.when((marks > 0) & (marks % 2 == 0), done).otherwise(block)


def masked_blocks(text: Column) -> Column:
    """The text with inner dots masked and quotes and brackets made uniform, cut before blank lines and list items."""
    t = F.translate(text, "“”„«»「」『』‹›()（）", '"' * 11 + "(" * 4)
    listed = F.regexp_replace(t, r"(?m)^([ \t]{0,8}\d{1,3})\((?=[ \t])", "$1" + DOT)
    return F.split(F.regexp_replace(F.regexp_replace(listed, MASK, DOT), _BLOCK, "\n" + CUT), CUT)


def sentence_pieces(blocks: DataFrame) -> DataFrame:
    """blocks (b, ...) with ``p``: the masked block cut into sentences, white space still at their ends. One select for each step, as
    an expression used several times in one select would be worked out several times."""
    rest = [c for c in blocks.columns if c != "b"]
    step = blocks.select(*rest, "b", _inside(F.col("b"), '"', IN_QUOTE, QUOTE_END, SAID_END).alias("h"))
    step = step.select(*rest, "b", _inside(F.col("h"), "(", IN_BRACKET, BRACKET_END, None).alias("h"))
    lower = ~F.col("b").rlike(r"\p{Lu}") & F.col("b").rlike(r"\p{Ll}")  # a block without capitals
    thai = F.col("b").rlike(r"[\u0e00-\u0e7f]")
    step = step.select(*rest, thai.alias("thai"), F.when(lower, F.regexp_replace("h", _LOWER, "$0" + CUT)).otherwise(F.regexp_replace("h", _CASED, "$0" + CUT)).alias("h"))
    return step.select(*rest, F.split(F.when(F.col("thai"), F.regexp_replace("h", _THAI, "$0" + CUT)).otherwise(F.col("h")), CUT).alias("p"))


def _starts(lengths: Column, first: Column) -> Column:
    """Running sums: the position at which each item begins. Sums run inside chunks and over the chunks' totals, as a growing
    array is copied at each step: the work for n items is n times CHUNK, not n times n."""
    running = lambda xs, at: F.slice(F.aggregate(xs, F.array(at), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))), 1, F.size(xs))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int")), lambda c: F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK)))
    totals = F.transform(chunks, lambda xs: F.aggregate(xs, F.lit(0), lambda a, n: a + n))
    long = F.flatten(F.zip_with(chunks, running(totals, first), running))
    return F.when(F.size(lengths) <= CHUNK, running(lengths, first)).otherwise(long)


def sentences(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, start_pos, end_pos) of each sentence unit; positions count code points, the end is exclusive.

    Null, empty and blank texts give no unit; repeated rows give their units again; other columns are ignored."""
    rows = docs.select(F.col(id_).alias("_id"), masked_blocks(F.col(text)).alias("b")).filter(F.col("b").isNotNull())
    rows = rows.select("_id", "b", F.transform("b", lambda x: F.length(x)).alias("n"))
    block = rows.select("_id", F.explode(F.arrays_zip("b", _starts(F.col("n"), F.lit(0)).alias("at"))).alias("z")).select("_id", F.col("z.at").alias("at"), F.col("z.b").alias("b"))
    piece = sentence_pieces(block).select("_id", "at", "p", F.transform("p", lambda x: F.length(x)).alias("n"))
    piece = piece.select("_id", F.explode(F.arrays_zip("p", _starts(F.col("n"), F.col("at")).alias("at"))).alias("z")).select("_id", F.col("z.p").alias("p"), F.col("z.at").alias("at"))
    unit = piece.select("_id", "at", F.length(F.rtrim(F.col("p"), F.lit(BLANKS))).alias("r"), (F.length("p") - F.length(F.ltrim(F.col("p"), F.lit(BLANKS)))).alias("l")).filter("r > 0")
    return unit.select(F.col("_id").alias(id_), (F.col("at") + F.col("l")).cast("long").alias("start_pos"), (F.col("at") + F.col("r")).cast("long").alias("end_pos"))


def p10_found(spark, d: str) -> DataFrame:
    return sentences(table(spark, d, "documents"))


QUERIES = {"p10_found": p10_found}
ORACLE: dict[str, str] = {}
