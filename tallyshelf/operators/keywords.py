"""Keyword planning and crawl progress as table jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .gates import GateError

# Search refinements, in the order they are tried.
QUALIFIERS = ["人気", "ランキング", "送料無料", "新品", "日本製", "大容量", "コンパクト", "業務用", "セット", "限定"]
# Category of the first group with a marker inside the word.
CATEGORY_MARKERS = {
    "家電": ["パソコン", "スマホ", "カメラ", "テレビ", "冷蔵庫", "洗濯", "掃除", "エアコン", "イヤホン"],
    "家具": ["ソファ", "ベッド", "テーブル", "収納", "カーテン", "照明", "ラック"],
    "ファッション": ["シャツ", "パンツ", "バッグ", "靴", "スニーカー", "コート", "財布"],
    "美容": ["化粧", "美容", "シャンプー", "香水", "ネイル", "歯"],
    "スポーツ": ["ゴルフ", "釣り", "自転車", "キャンプ", "テント", "ヨガ", "ランニング"],
    "工具": ["工具", "ドリル", "レンチ", "のこ", "DIY", "塗料"],
    "食品": ["米", "コーヒー", "茶", "麺", "菓子", "調味"],
    "ペット": ["犬", "猫", "ペット", "水槽"],
    "本・趣味": ["本", "漫画", "模型", "楽器", "ギター", "フィギュア"],
}
DEFAULT_CATEGORY, SUBCATEGORY = "生活用品", "商品検索"
HIGH_PRIORITY = 300


def keyword_normalize(texts: DataFrame, order: list[str], column: str = "text") -> DataFrame:
    """Distinct normalized words with the place of their first occurrence.

    ``order`` names the columns that order the texts; ``first_seen`` is the
    struct (order columns, position in the text). Texts are cut before words
    are normalized, so a full-width comma stays part of its word. Only distinct
    words as written go to Python.
    """
    words = texts.select(*order, F.posexplode(X.split_words(F.col(column))).alias("position", "_raw"))
    written = words.groupBy("_raw").agg(F.min(F.struct(*order, "position")).alias("first_seen"))
    clean = written.select(X.strip_unicode(X.nfkc(F.col("_raw"))).alias("keyword"), "first_seen").filter("keyword <> ''")
    return clean.groupBy("keyword").agg(F.min("first_seen").alias("first_seen"))


def keyword_category(word: Column, markers: dict[str, list[str]] | None = None, default: str = DEFAULT_CATEGORY) -> Column:
    category = F.when(F.lit(False), default)
    for name, parts in (markers or CATEGORY_MARKERS).items():
        hit = F.lit(False)
        for part in parts:
            hit = hit | word.contains(part)
        category = category.when(hit, name)
    return category.otherwise(default)


def keyword_classify(
    words: DataFrame, markers: dict[str, list[str]] | None = None, default: str = DEFAULT_CATEGORY
) -> DataFrame:
    return words.withColumns({
        "category": keyword_category(F.col("keyword"), markers, default), "subcategory": F.lit(SUBCATEGORY)
    })


def keyword_priority(words: DataFrame, order: str = "first_seen", high: int = HIGH_PRIORITY) -> DataFrame:
    """Every word as pending; the first ``high`` words have high priority.

    Only the boundary is looked up (one row), then each word compares itself.
    """
    place = F.struct(order, "keyword")
    top = words.select(place.alias("_place")).orderBy("_place").limit(high)
    boundary = top.agg(F.max("_place").alias("_last"))
    level = F.when(place <= boundary.scalar(), "high").otherwise("normal")
    return words.select("keyword", level.alias("priority"), F.lit("pending").alias("status"))


def keyword_cross_refine(
    words: DataFrame, qualifiers: list[str] | None = None, size: int | None = None, order: str = "first_seen"
) -> DataFrame:
    """Words with every ordered choice of qualifiers behind them, in list order.

    Each qualifier in turn refines all keywords so far, refined ones included.
    So a word's refinements are the subsets of the qualifiers, numbered in
    binary: bit k of ``refinement`` is the k-th qualifier, 0 the plain word, and
    (refinement, place) is the list order. They come from a literal array on
    each word, ``2 ** len(qualifiers)`` of them; a keyword that arises twice
    keeps its first place. All are returned unless ``size`` is given: then the
    plain words and the first refinements up to that many keywords, and too few
    keywords in all are an error.
    """
    qualifiers = QUALIFIERS if qualifiers is None else qualifiers
    subsets = F.array(*[
        F.struct(F.lit(m).alias("refinement"), F.lit("".join(f" {q}" for k, q in enumerate(qualifiers) if m >> k & 1)).alias("tail"))
        for m in range(1 << len(qualifiers))
    ])
    refined = words.select(F.col("keyword").alias("_word"), F.col(order).alias("place"), F.explode(subsets).alias("_s"))
    keywords = refined.groupBy(F.concat("_word", "_s.tail").alias("keyword")).agg(
        F.min(F.struct("_s.refinement", "place")).alias("_f")
    ).select("keyword", "_f.refinement", "_f.place")
    if size is None:
        return keywords
    counts = keywords.agg(F.count("*").alias("all"), F.count_if(F.col("refinement") == 0).alias("plain")).first()
    if counts["all"] < size:
        raise GateError(f"only {counts['all']} distinct keywords, {size} wanted")
    fill = keywords.filter("refinement > 0").orderBy("refinement", "place").limit(max(0, size - counts["plain"]))
    return keywords.filter("refinement = 0").unionByName(fill)


def keyword_reconcile(plan: DataFrame, state: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Plan rows with the status, page and time of their crawl state.

    Only completed and partial states count; a state without a completion time
    takes ``updated_at``.
    """
    known = state.filter(F.col("state").isin("completed", "partial")).select(
        "keyword", F.col("state").alias("_state"), F.coalesce("last_page", F.lit(0)).alias("_page"),
        F.coalesce("completed_at", updated_at if updated_at is not None else F.lit(None)).alias("_at"),
    )
    found = F.col("_state").isNotNull()
    kept = [c for c in plan.columns if c not in ("status", "last_page", "last_run_at")]
    return plan.join(known, "keyword", "left").select(
        *kept,
        F.coalesce("_state", "status").alias("status"),
        F.when(found, F.col("_page")).otherwise(F.col("last_page")).alias("last_page"),
        F.when(found, F.col("_at")).otherwise(F.col("last_run_at")).alias("last_run_at"),
    )


def select_work(
    plan: DataFrame, state: DataFrame, persisted: DataFrame, max_pages: int, limit: int, newest: str = "last_page"
) -> DataFrame:
    """Next (keyword, page) to fetch, in plan order.

    Completed keywords are skipped, others resume behind their last page, and
    pages already persisted are left out. ``plan`` holds (keyword, plan_no). Of
    several states of a keyword the one with the largest ``newest`` counts, then
    the further page, then the completed one. Pages left are counted per keyword first; only the first
    ``limit`` keywords that have any are expanded to pages.
    """
    place = F.struct(F.col(newest).alias("_newest"), F.col("last_page"), (F.col("state") == "completed").alias("_done"), F.col("state"))
    known = state.groupBy("keyword").agg(F.max(place).alias("_s")).select("keyword", "_s.state", "_s.last_page")
    open_words = plan.select("keyword", "plan_no").join(known, "keyword", "left").filter(~F.col("state").eqNullSafe("completed"))
    open_words = open_words.select("keyword", "plan_no", (F.coalesce("last_page", F.lit(0)) + 1).alias("_start"))
    stored = persisted.select("keyword", "page").distinct()
    taken = open_words.join(stored, "keyword").filter(F.col("page").between(F.col("_start"), max_pages)).groupBy("keyword").agg(
        F.count("*").alias("_taken")
    )
    left = max_pages - F.col("_start") + 1 - F.coalesce("_taken", F.lit(0))
    first = open_words.join(taken, "keyword", "left").filter(left > 0).orderBy("plan_no").limit(limit)
    todo = first.select("keyword", "plan_no", F.explode(F.sequence("_start", F.lit(max_pages))).alias("page"))
    fresh = todo.join(stored, ["keyword", "page"], "left_anti")
    return fresh.orderBy("plan_no", "page").limit(limit).select("keyword", "page")
