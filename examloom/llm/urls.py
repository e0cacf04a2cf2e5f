"""URL filters (operator 9): rules first, else logistic regression on hashed character n-grams.

The model is fitted on the driver from a small table of labelled URLs and its
weights are whole numbers, so the sum of a URL's weights is the same on every
engine. Judging uses Spark SQL functions only. An n-gram of host or path is
hashed by the code points of its characters.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS = 4096
SIZES = (3, 4)
SCALE = 1_000_000
#: A labelled table of more rows than this is refused: it is held on the driver.
MAX_LABELLED = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A small labelled table, written without a look at any table of pages: kinds of site that corpus builders drop, and kinds that they keep.
_DROPPED = """
http://rx-discount-drugstore.test/buy/viagra
https://no-prescription-meds.test/cialis/order
https://www.online-pharmacy-deals.test/weight-loss-pills
http://diet-pills-direct.test/order?id=7
https://canadian-drugs-cheap.test/index.php?item=44
http://generic-tabs-shop.test/pharmacy/sale
https://miracle-slimming-tea.test/buy-now
https://muscle-boosters-4u.test/steroids/cheap
https://royal-slots-casino.test/free-spins
http://vegas-jackpot-games.test/casino/bonus
https://poker-bonus-rooms.test/signup?ref=88
https://www.betting-odds-free.test/sports/bets
http://bingo-win-cash.test/join
https://roulette-king.test/play-for-money
http://best-bookmaker-bonus.test/bet
https://lottery-winner-claim.test/prize?user=5
http://hot-singles-tonight.test/chat/adult
https://xxx-tube-videos.test/watch/123
http://live-sex-cams.test/models
https://www.porn-pics-gallery.test/xxx
https://adult-dating-free.test/register
http://escort-girls-city.test/ads
https://nude-celebs-leak.test/photos
http://full-version-cracks.test/download/keygen.exe
https://warez-torrent-hub.test/crack/serial
http://free-movie-streams-hd.test/watch-online-free
https://cracked-apps-mod.test/apk/download
https://serial-keys-free.test/windows/activator
http://game-cheats-hack.test/free-coins-generator
https://unlimited-gems-hack.test/generator
https://instant-payday-loan.test/apply-now
http://bad-credit-cash-fast.test/loan
https://quick-money-lender.test/approved/no-credit-check
http://consolidate-debt-free.test/offer
https://make-money-at-home.test/secret-system
http://forex-signals-profit.test/vip
https://crypto-doubler-invest.test/deposit/bitcoin
https://binary-options-rich.test/join-free
http://get-rich-quick-club.test/earn/cash
https://replica-handbags-outlet.test/louis/sale
http://fake-rolex-watches.test/buy-cheap
https://discount-sneakers-outlet.test/jordans-cheap
https://cheap-designer-bags.test/sale?off=90
http://knockoff-sunglasses-store.test/cheap/order
https://buy-backlinks-seo.test/rank/links
http://link-exchange-network.test/submit/links
https://seo-traffic-bot.test/buy-visitors
http://article-spinner-spam.test/auto-post
https://directory-free-links.test/add-url
https://guest-post-links-cheap.test/seo
http://doorway-pages-generator.test/keywords
https://bulk-email-lists.test/buy/leads
http://email-blaster-spam.test/mailer
https://buy-followers-likes.test/instagram/cheap
https://click-tracker-ads.test/redirect?url=1
http://ad-server-banners.test/banner.gif?zone=3
https://pixel-tracking-net.test/pixel?uid=77
https://popup-ads-network.test/popunder.js
http://affiliate-clicks.test/go?aff=19
https://you-wont-believe-this.test/shocking/celebrity-secret
http://shocking-weird-trick.test/one-trick
https://viral-clickbait-news.test/number-7-will-shock-you
http://win-free-phone-now.test/claim-prize
https://survey-rewards-gift-card.test/free/claim
http://congratulations-winner.test/gift?id=1
https://account-verify-login.test/secure/update-password
http://bank-secure-verify.test/login/confirm
https://paypa1-support-verify.test/signin
http://apple-id-locked.test/verify
https://virus-alert-pc-fix.test/call-now
http://free-registry-cleaner.test/download.exe
https://essay-writing-cheap.test/buy-essay
http://fake-diploma-buy.test/degree/order
https://psychic-love-spells.test/buy-spell
http://parked-domain-sale.test/?ads=1
https://free-ringtones-download.test/mobile/free
""".split()
_KEPT = """
https://encyclopedia.test/wiki/Photosynthesis
https://en.openwiki.test/wiki/History_of_Rome
https://www.statelibrary.test/catalogue/record/18221
https://archive.records.test/details/letters1890
https://www.oldtown-museum.test/collections/pottery
https://gallery.arts.test/exhibitions/2018
https://www.northuniversity.test/faculty/physics/research
https://cs.college.test/courses/algorithms/lecture3.html
https://math.institute.test/seminar/2021/spring
https://school.district.test/calendar/term2
https://openlearning.test/course/biology/unit4
https://press.university.test/books/linguistics
https://journal.chemistry.test/articles/10/2/55
https://preprints.science.test/abs/2103.01234
https://proceedings.conference.test/2019/paper117.pdf
https://www.medicaljournal.test/doi/10.1000/182
https://hospital.city.test/departments/cardiology
https://health.ministry.test/guidelines/nutrition
https://www.parliament.test/debates/2020-03-11
https://gov.test/services/passports
https://statistics.office.test/population/tables
https://court.test/judgments/2017/ca-221
https://weather.service.test/forecast/coast
https://geo.survey.test/maps/sheet42
https://space.agency.test/missions/probe
https://www.dailyherald.test/2020/06/14/local/bridge-opens
https://news.morningpost.test/world/article1182
https://www.radiostation.test/programmes/evening
https://www.sportsreport.test/football/match-report
https://economist-review.test/essays/trade
https://magazine.nature.test/issue/12/rivers
https://blog.engineer.test/2018/10/compilers
https://notes.astronomer.test/jupiter-moons
https://diary.traveller.test/peru/day-9
https://janes.kitchen.test/recipes/lentil-soup
https://www.breadbaking.test/sourdough/starter
https://gardeners.corner.test/roses/pruning
https://birdwatch.test/species/heron
https://forum.photography.test/thread/5521?page=3
https://discuss.cyclists.test/t/gear-ratios/881
https://questions.coders.test/q/40291/sort-a-list
https://community.linuxusers.test/viewtopic.php?t=77
https://mail.lists.kernel.test/2015/04/msg00012.html
https://docs.framework.test/en/stable/tutorial.html
https://developer.platform.test/reference/http-client
https://manual.database.test/sql/select
https://code.repository.test/project/readme
https://bugs.tracker.test/issue/1044
https://packages.distro.test/editors/vim
https://standards.test/rfc/2616
https://www.poetryfoundation.test/poems/autumn
https://stories.shortfiction.test/the-lighthouse
https://theatre.test/season/hamlet
https://music.conservatory.test/scores/bach
https://film.reviews.test/2016/quiet-river
https://bookshelf.readers.test/reviews/novel-31
https://genealogy.test/families/hartmann
https://language.dictionary.test/word/serendipity
https://translate.lessons.test/fr/verbes
https://www.philosophy.test/entries/kant
https://www.cityhall.test/de/buergerservice
https://www.biblioteca.test/es/catalogo/312
https://www.mairie-village.test/fr/actualites
https://zeitung.test/politik/artikel-552.html
https://elperiodico.test/cultura/2019/teatro
https://www.lejournal.test/societe/article88
https://hotel.mountain.test/rooms
https://railway.test/timetable/line5
https://airport.test/arrivals
https://www.farmersmarket.test/stalls/honey
https://www.carpenter.test/workshop/chairs
https://charity.foodbank.test/volunteer
https://church.stmary.test/services/sunday
https://www.chessclub.test/tournaments/2022
https://rowing.club.test/regatta/results
https://astronomy.society.test/observing/meteors
https://www.zoo.test/animals/otter
https://www.observatory.test/visits
""".split()
LABELLED: tuple[tuple[str, int], ...] = (*((u, 1) for u in _DROPPED), *((u, 0) for u in _KEPT))
FOLDS = 5
#: What a URL's weights must exceed, in millionths: the least multiple of a quarter at which 19 of 20 blocked rows of ``LABELLED`` are rightly blocked by models not fitted on them.
MARGIN = 1_000_000


@dataclass(frozen=True)
class Rule:
    """A host, with all its subdomains, and a path prefix. Written ``host/path``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow"))


def bucket(gram: str, part: int) -> int:
    """The bucket of an n-gram; part 0 is the host, 1 the path."""
    h = 7 + part
    for c in gram:
        h = (h * 131 + ord(c)) % 1_000_003
    return h % BUCKETS


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path. A null or a URL without ``://`` has neither."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min((rest.index(c) for c in "?#" if c in rest), default=len(rest))
    return host.translate(str.maketrans(UPPER, LOWER)), rest[:end]


@dataclass
class Model:
    """Weights in millionths; a URL is blocked if its sum is above zero."""

    bias: int
    weights: list[int] = field(repr=False)

    def total(self, host: str, path: str) -> int:
        return self.bias + sum(self.weights[bucket(s[i : i + n], part)] for part, s in enumerate((host, path)) for n in SIZES for i in range(len(s) - n + 1))


def fit(labelled: Iterable[tuple[str, int]], margin: int = MARGIN, steps: int = 300, rate: float = 0.05, shrink: float = 1e-3) -> Model:
    """Logistic regression by full gradient steps; the margin goes into the bias. An empty table gives a model that blocks nothing."""
    rows = []
    for url, label in labelled:
        counts: dict[int, int] = {}
        for part, s in enumerate(split_url(url)):
            for n in SIZES:
                for i in range(len(s) - n + 1):
                    b = bucket(s[i : i + n], part)
                    counts[b] = counts.get(b, 0) + 1
        rows.append((counts, label))
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"at most {MAX_LABELLED} labelled URLs are fitted")
    weights, bias = [0.0] * BUCKETS, 0.0
    for _ in range(steps if rows else 0):
        slope: dict[int, float] = {}
        tilt = 0.0
        for counts, label in rows:
            z = bias + sum(weights[b] * n for b, n in counts.items())
            miss = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - label
            tilt += miss
            for b, n in counts.items():
                slope[b] = slope.get(b, 0.0) + miss * n
        bias -= rate * tilt / len(rows) * 10
        for b, g in slope.items():
            weights[b] -= rate * (g + shrink * weights[b])
    return Model(round(bias * SCALE) - margin, [round(w * SCALE) for w in weights])


@cache
def default_model() -> Model:
    """The model of ``LABELLED``, fitted once."""
    return fit(LABELLED)


def measured(labelled: Iterable[tuple[str, int]] = LABELLED) -> tuple[float, float, float]:
    """Precision and recall of block, and accuracy, of rows that the model judging them was not fitted on: ``FOLDS`` folds by hash of the URL."""
    rows = [(u, y, zlib.crc32(u.encode()) % FOLDS) for u, y in labelled]
    found = []
    for fold in range(FOLDS):
        model = fit([(u, y) for u, y, f in rows if f != fold])
        found += [(model.total(*split_url(u)) > 0, bool(y)) for u, y, f in rows if f == fold]
    right = sum(p and y for p, y in found)
    return right / max(1, sum(p for p, _ in found)), right / max(1, sum(y for _, y in found)), sum(p == y for p, y in found) / max(1, len(found))


def fit_table(labelled: DataFrame, url_col: str = "url", label_col: str = "label") -> Model:
    """``fit`` on a small DataFrame of URLs; more than ``MAX_LABELLED`` rows are refused, rows without a label left out."""
    rows = labelled.select(common.col(url_col), common.col(label_col)).where(common.col(label_col).isNotNull()).orderBy(common.col(url_col)).limit(MAX_LABELLED + 1).collect()
    return fit([(r[0], int(r[1])) for r in rows])


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _grams_total(s: Column, part: int, weights: Column) -> Column:
    """The sum of the weights of all n-grams of a string."""
    codes = F.transform(F.filter(F.split(s, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    totals = F.lit(0).cast("long")
    for n in SIZES:
        starts = F.when(F.length(s) >= n, F.sequence(F.lit(1), F.length(s) - (n - 1))).otherwise(F.array().cast("array<int>"))

        totals += F.aggregate(starts, F.lit(0).cast("long"), _adder(codes, n, part, weights))
    return totals


def _adder(codes: Column, n: int, part: int, weights: Column) -> Callable[[Column, Column], Column]:
    """Adds the weight of the n-gram that starts at i."""

    def add(total: Column, i: Column) -> Column:
        h = F.lit(7 + part).cast("long")
        for k in range(n):
            h = (h * 131 + F.element_at(codes, i + k)) % 1_000_003
        return total + F.element_at(weights, (h % BUCKETS).cast("int") + 1).cast("long")

    return add


def judge(df: DataFrame, model: Model, rules: Iterable[Rule] = RULES, url_col: str = "url") -> DataFrame:
    """``df`` with host, path, rule and verdict of its URLs; columns of these names are replaced.

    The longest rule that fits decides; of rules of one length the first given.
    Where none fits, the model does: rule is null and the verdict is block if
    the URL's weights sum to more than zero. A null URL, or one without
    ``://``, has an empty host and path, fits no rule and gets the verdict of
    the model's bias. Repeated rows are judged each; an empty table stays empty.
    """
    host_col, path_col = common.fresh(df, "__host"), common.fresh(df, "__path")
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    url = common.col(url_col)
    parts = df.withColumns({host_col: host_of(url), path_col: path_of(url)})
    host, path = F.col(host_col), F.col(path_col)
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in rules]
    ordered = sorted(zip(rules, fits), key=lambda x: -len(x[0].text))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r, fit_ in reversed(ordered):
        rule, verdict = F.when(fit_, r.text).otherwise(rule), F.when(fit_, r.verdict).otherwise(verdict)
    weights = F.from_json(F.lit(json.dumps(model.weights)), "array<int>")
    total = _grams_total(host, 0, weights) + _grams_total(path, 1, weights) + model.bias
    return parts.select(
        *[common.col(c) for c in kept],
        host.alias("host"),
        path.alias("path"),
        rule.alias("rule"),
        F.coalesce(verdict, F.when(total > 0, "block").otherwise("allow")).alias("verdict"),
    )


def judge_sql(model: Model, rules: Iterable[Rule] = RULES) -> str:
    """The same over ``pages`` as DuckDB SQL."""
    ordered = sorted(rules, key=lambda r: -len(r.text))
    fits = {r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))" for r in ordered}
    case = lambda f: "CASE " + " ".join(f"WHEN {fits[r]} THEN '{f(r)}'" for r in ordered) + " END"
    sums = []
    for part, s in enumerate(("host", "path")):
        for n in SIZES:
            h = str(7 + part)
            for k in range(n):
                h = f"((({h}) * 131 + unicode(substr({s}, i + {k}, 1))) % 1000003)"
            sums.append(f"coalesce(list_sum([w[CAST({h} % {BUCKETS} AS INT) + 1] FOR i IN range(1, CAST(length({s}) AS INT) - {n - 2})]), 0)")
    lower = f"translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
    return f"""
WITH weights AS (SELECT CAST({model.weights} AS INT[]) AS w),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id, coalesce({lower}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut)
SELECT page_id, host, path, {case(lambda r: r.text)} AS rule,
  coalesce({case(lambda r: r.verdict)}, CASE WHEN {' + '.join(sums)} + ({model.bias}) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM parts, weights"""
