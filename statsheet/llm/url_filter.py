"""URL filter: rules by host and path, then a weighted URL vocabulary.

Rules decide where one fits (the longest text wins, then the longer host).
Everything else is judged by the vocabulary: an Aho-Corasick automaton finds
all terms of the lower-cased URL in one pass; a hit counts only between word
boundaries (no letter or digit beside it).  One strict term, or several
different soft terms, block the URL; the forms of a word are one term.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
so no rule fits; a null URL is allowed.  A term that occurs twice counts once.
Rows keep their number; repeated rows get equal verdicts; the input's other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Out, prepare, rows_of

# A term is a word, or a word with its forms: ``bet(s|ting)?`` stands for bet, bets
# and betting, ``gambl(e|ing)`` for gamble and gambling.  The forms of a term count
# as one.  Strict are words whose plain sense is the unwanted subject; words with
# an everyday sense as well are soft.  Words of any shop or page (free, cheap, win,
# sale, download) are in neither list, since two of them say nothing.

#: One of these blocks.
STRICT = (
    # adult
    "porn(s|o|os)?", "pornograph(y|ic|er|ers)", "pornstar(s)?", "porntube(s)?", "pornhub", "freeporn", "youporn", "redtube", "xvideo(s)?", "xhamster", "xnxx",
    "xxx", "hentai", "ecchi", "camgirl(s)?", "camboy(s)?", "camsex", "sexcam(s)?", "livesex", "cybersex", "phonesex", "sextape(s)?", "sexshop(s)?", "sexchat(s)?",
    "milf(s)?", "gilf(s)?", "blowjob(s)?", "handjob(s)?", "footjob(s)?", "rimjob(s)?", "cumshot(s)?", "creampie(s)?", "deepthroat(s|ing)?", "gangbang(s|ed|ing)?", "bukkake",
    "threesome(s)?", "orgy", "orgies", "upskirt(s)?", "downblouse", "fetish(es)?", "bdsm", "femdom", "futanari", "masturbat(e|es|ed|ing|ion)", "dildo(s|es)?", "fleshlight(s)?",
    "fuck(s|ed|er|ers|ing)?", "slut(s|ty)?", "whore(s)?", "shemale(s)?", "ladyboy(s)?", "tranny", "trannies", "jailbait", "incest", "bestiality", "zoophilia", "nsfw",
    "onlyfans", "fansly", "chaturbate", "callgirl(s)?", "stripclub(s)?", "swinger(s)?", "titties", "boobies", "camwhore(s)?", "hardcoresex",
    # gambling
    "casino(s)?", "onlinecasino(s)?", "sportsbook(s)?", "sportsbet(s|ting)?", "bookie(s)?", "freebet(s)?", "freespin(s)?", "videopoker", "slotmachine(s)?", "videoslot(s)?",
    "baccarat", "sicbo", "togel", "pachinko", "sbobet", "judi",
    # pharmacy
    "viagra", "cialis", "levitra", "kamagra",
    # copied software, malware, spam, trackers
    "warez", "nulled", "crackz", "serialz", "phish(ed|er|ers|ing)", "malware(s)?",
    "linkfarm(s)?", "spamdex(ing)?", "doorwaypage(s)?", "adserver(s)?", "adserv(e|ing)", "adclick(s)?", "adtrack(er|ers|ing)?", "popunder(s)?", "clicktrack(er|ers|ing)?",
)
#: Several different ones block.
SOFT = (
    # adult
    "adult", "sex(y)?", "erotic(a|ally)?", "nude(s)?", "nudity", "nudist(s)?", "naked", "topless", "lingerie", "escort(s|ing)?", "dating", "hookup(s)?", "singles", "stripper(s)?", "striptease(s)?", "stripping",
    "webcam(s)?", "hardcore", "uncensored", "busty", "horny", "naughty", "kinky", "kink(s)?", "anal", "penis(es)?", "boob(s)?", "tits", "ass(es)?",
    "orgasm(s|ic)?", "seduc(e|ed|es|tion|tive)", "voyeur(s|ism)?", "spank(s|ed|ing)?", "bondage", "brothel(s)?", "prostitut(e|es|ion)", "playboy", "playmate(s)?",
    # gambling
    "gambl(e|es|ed|er|ers|ing)", "bet(s|ting|tor|tors)?", "wager(s|ed|ing)?", "bookmaker(s)?", "odds", "poker", "holdem", "blackjack", "roulette(s)?", "craps", "keno", "bingo", "slot(s)?", "jackpot(s)?", "lotter(y|ies)", "lotto(s)?",
    "sweepstake(s)?", "raffle(s)?", "scratchcard(s)?", "parlay(s)?", "payout(s)?", "highroller(s)?", "croupier(s)?",
    # pharmacy
    "pill(s)?", "pharmac(y|ies)", "pharma(s)?", "drugstore(s)?", "rx", "sildenafil", "tadalafil", "vardenafil", "xanax", "valium", "ambien", "adipex", "phentermine", "tramadol", "oxycontin", "oxycodone", "hydrocodone", "percocet", "vicodin", "modafinil", "clenbuterol", "steroid(s)?", "anabolic", "erectile", "erection(s)?", "impotence", "libido",
    "enlargement(s)?", "slimming", "weightloss", "hgh", "kratom", "cbd", "vape(s)?", "vaping",
    # money and fakes
    "loan(s)?", "payday", "lender(s)?", "refinanc(e|ing)", "forex", "replica(s)?", "counterfeit(s)?", "knockoff(s)?", "fake(s)?", "ponzi", "scam(s|med|mer|mers|ming)?", "moneymaking", "giveaway(s)?",
    # copied software, malware, spam, trackers
    "torrent(s)?", "crack(s|ed|er|ers|ing)?", "keygen", "serials", "pirat(ed|es|ing|acy)", "cheats", "exploit(s|ed|ing)?", "dropper(s)?", "spyware", "adware", "scareware", "ransomware", "botnet(s)?", "keylogger(s)?", "rootkit(s)?", "trojan(s)?", "spam(s|med|mer|mers|ming|my)?",
    "backlink(s)?", "seo", "autoblog(s|ging)?", "ads", "advert(s|ising)?", "adsense", "adwords", "banner(s)?", "popup(s)?", "affiliate(s)?", "doubleclick", "clickthrough(s)?", "track(s|ed|er|ers|ing)?", "pixel(s)?", "beacon(s)?", "retarget(ed|ing)?",
)
SOFT_LIMIT = 2

_TERM = re.compile(r"([^()?|]+)(?:\(([^()?]+)\)(\??))?")
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_END_HOST = re.compile(r"[/?#]")
_END_PATH = re.compile(r"[?#]")


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that start with ``path``."""

    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Vocabulary:
    strict: tuple[str, ...] = STRICT
    soft: tuple[str, ...] = SOFT
    soft_limit: int = SOFT_LIMIT


def split_url(url: str | None) -> tuple[str, str]:
    """(host with A-Z lowered, path) as written; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    m = _END_HOST.search(rest)
    cut = m.start() if m else len(rest)
    tail = rest[cut:]
    m = _END_PATH.search(tail)
    return rest[:cut].translate(_ASCII_LOWER), tail[: m.start()] if m else tail


def forms(term: str) -> list[str]:
    """The words a term stands for."""
    m = _TERM.fullmatch(term)
    if not m:
        raise ValueError(f"no word or word(ending|ending)?: {term!r}")
    stem, endings, bare = m.groups()
    return [stem] if endings is None else [stem + e for e in endings.split("|")] + [stem] * bool(bare)


@dataclass
class Judge:
    rules: tuple[Rule, ...]
    vocabulary: Vocabulary
    by_host: dict[str, list[Rule]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        import ahocorasick

        for r in sorted(self.rules, key=lambda r: (-len(r.text), -len(r.host), r.text)):
            self.by_host.setdefault(r.host, []).append(r)
        self.terms = ahocorasick.Automaton()
        of_word: dict[str, set[tuple[str, str]]] = {}
        for kind, terms in (("soft", self.vocabulary.soft), ("strict", self.vocabulary.strict)):
            for t in terms:
                for word in forms(t):
                    of_word.setdefault(word, set()).add((kind, t))
        for word, of in of_word.items():
            self.terms.add_word(word, (len(word), of))
        if len(self.terms):
            self.terms.make_automaton()

    def rule(self, host: str, path: str) -> Rule | None:
        """The longest fitting rule: looks up each suffix of the host, not each rule."""
        best = None
        at = 0
        while True:
            for r in self.by_host.get(host[at:], ()):
                if path.startswith(r.path):
                    if best is None or (len(r.text), len(r.host)) > (len(best.text), len(best.host)):
                        best = r
                    break
            at = host.find(".", at) + 1
            if not at:
                return best

    def hits(self, url: str | None) -> tuple[int, int]:
        """(strict terms, soft terms) found between boundaries, each counted once."""
        text = (url or "").translate(_ASCII_LOWER)
        found = set()
        if text and len(self.terms):
            for end, (length, of) in self.terms.iter(text):
                start = end + 1 - length
                if not (start and text[start - 1].isalnum()) and not text[end + 1 : end + 2].isalnum():
                    found |= of
        strict = sum(k == "strict" for k, _ in found)
        return strict, len(found) - strict

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, int, int]:
        host, path = split_url(url)
        rule = self.rule(host, path)
        strict, soft = self.hits(url)
        verdict = rule.verdict if rule else "block" if strict or soft >= self.vocabulary.soft_limit else "allow"
        return host, path, rule.text if rule else None, verdict, strict, soft


_OUT = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("strict_terms", pa.int32()), ("soft_terms", pa.int32())])


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = (), vocabulary: Vocabulary = Vocabulary(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict and the term counts.
    No shuffle; only the id and URL columns are read."""
    prepare(pages.sparkSession)
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, out = Judge(rules, vocabulary), Out(_OUT)
        for rows in rows_of(batches, "page_id", "url"):
            for page_id, url in rows:
                out.add(page_id, *judge.judge(url))
                if out.full():
                    yield out.take()
        yield out.take()

    return pages.selectExpr(f"cast(`{id_col}` as bigint) page_id", f"cast(`{url_col}` as string) url").mapInArrow(run, "page_id bigint, host string, path string, rule string, verdict string, strict_terms int, soft_terms int")
