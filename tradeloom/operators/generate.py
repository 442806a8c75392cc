"""Marketplace data at any size, from ids and a seed.

Every value is a function of a row's id and the seed, so the same rows come out
at any number of partitions and after any retry.  Ids come in as a DataFrame
(``spark.range`` or an existing table), so generation is a projection, plus a
few joins to hand out goods and categories.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.hashing import chance, mix, pick, pick_from
from tradeloom.operators.joins import assign_by_hash, assign_from, customers, numbered_pool
from tradeloom.operators.rankings import enumerated, shuffled
from tradeloom.plans.ordered import top_per_group

# Word lists of the sample data.
FIRST_NAMES = [
    "Иван", "Петр", "Мария", "Анна", "Сергей", "Ольга", "Алексей", "Елена",
    "Дмитрий", "Наталья", "Андрей", "Татьяна", "Михаил", "Светлана", "Владимир",
]
LAST_NAMES = [
    "Иванов", "Петров", "Сидоров", "Кузнецов", "Попов", "Васильев", "Смирнов", "Новиков",
    "Федоров", "Морозов", "Волков", "Алексеев", "Лебедев", "Семенов", "Егоров",
]
BRANDS = [
    "Samsung", "Apple", "Xiaomi", "Sony", "LG", "Philips", "Bosch", "Canon",
    "Nikon", "Huawei", "Lenovo", "Asus", "Acer", "HP", "Dell",
]
QUALITIES = [
    "Умный", "Профессиональный", "Домашний", "Портативный", "Электронный", "Цифровой",
    "Беспроводной", "Интеллектуальный", "Компактный", "Стильный",
]
THINGS = [
    "смартфон", "ноутбук", "планшет", "телевизор", "наушники", "часы", "монитор", "фотоаппарат",
    "принтер", "роутер", "микрофон", "динамик", "пылесос", "чайник", "блендер",
]
CITIES = [
    "Москва", "Санкт-Петербург", "Новосибирск", "Екатеринбург", "Казань", "Нижний Новгород",
    "Челябинск", "Самара", "Омск", "Ростов-на-Дону",
]
STREETS = [
    "Ленина", "Пушкина", "Гагарина", "Советская", "Мира", "Кирова", "Лесная", "Центральная",
    "Молодежная", "Школьная",
]
STREET_KINDS = ["ул.", "пр.", "пер.", "б-р", "ш."]
CATEGORIES = [
    "Электроника", "Бытовая техника", "Компьютеры и ноутбуки", "Смартфоны и гаджеты", "Фото и видео",
    "Аудиотехника", "Игры и развлечения", "Кухонная техника", "Красота и здоровье", "Автотовары",
]
COMMENTS = [
    "Отличный товар! Рекомендую",
    "Хорошее качество, доволен покупкой",
    "Нормальный товар за свои деньги",
    "Есть небольшие недочеты, но в целом неплохо",
    "Не советую, качество оставляет желать лучшего",
]
# Orders per customer; (upper bound of the draw, least, spread).
ORDER_BANDS = [
    (0.05, 0, 0), (0.15, 1, 0), (0.25, 2, 0), (0.40, 3, 0), (0.55, 4, 0),
    (0.70, 5, 0), (0.80, 6, 5), (0.90, 11, 5), (1.00, 21, 10),
]
MERCHANT_SHARE = 0.2
REVIEW_SHARE = 0.35
# Document seed.
SEED_CATEGORIES = ["Электроника", "Одежда", "Дом", "Спорт", "Книги"]
SEED_MERCHANTS = ["Магазин 1", "Магазин 2", "Магазин 3"]
SEED_GOODS = ["A", "B", "C", "D", "E", "F", "G", "H", "I", "J"]
# Event types, the first six of ``PRODUCED`` being sent by the feed.
EVENT_TYPES = [
    "OrderCreated", "OrderPaid", "OrderCancelled", "TrainingBooked", "SubscriptionExpired",
    "TripCreated", "CrashDetected", "BookIssued", "BookReturned",
]
PRODUCED = ["OrderCreated", "OrderPaid", "OrderCancelled", "TrainingBooked", "TripCreated", "BookIssued"]


def draw(key: Column | str, seed: int) -> Column:
    """Number in [0, 1) with four decimals."""
    return pick(key, 10000, seed) / F.lit(10000.0)


def rounded_draw(key: Column | str, seed: int, spread: int, least: int) -> Column:
    """``draw * spread + least`` rounded: both ends get half the weight."""
    return F.floor(draw(key, seed) * spread + least + 0.5)


def users(ids: DataFrame, seed: int = 1) -> DataFrame:
    return ids.select(
        F.col("id").alias("user_id"),
        F.md5(mix("id", seed).cast("string")).alias("password_hash"),
        F.concat_ws(" ", pick_from(FIRST_NAMES, "id", seed + 1), pick_from(LAST_NAMES, "id", seed + 2)).alias("name"),
        F.when(chance("id", MERCHANT_SHARE, seed + 3), "merchant").otherwise("customer").alias("user_type"),
    )


def addresses(ids: DataFrame, seed: int = 11) -> DataFrame:
    street = F.concat_ws(" ", pick_from(STREET_KINDS, "id", seed + 1), pick_from(STREETS, "id", seed + 2))
    house = F.concat(F.lit("д. "), (pick("id", 100, seed + 3) + 1).cast("string"))
    return ids.select(F.col("id").alias("addr_id"), F.concat_ws(", ", pick_from(CITIES, "id", seed), street, house).alias("name"))


def categories(spark) -> DataFrame:
    return spark.range(1).select(
        F.posexplode(F.array(*[F.lit(c) for c in CATEGORIES])).alias("i", "name")
    ).select((F.col("i") + 1).cast("bigint").alias("caty_id"), "name")


def product_name(key: Column | str, seed: int) -> Column:
    return F.concat_ws(
        " ",
        pick_from(BRANDS, key, seed),
        pick_from(QUALITIES, key, seed + 1),
        pick_from(THINGS, key, seed + 2),
        (pick(key, 9000, seed + 3) + 1000).cast("string"),
    )


def goods(merchants: DataFrame, total: Column, cats: DataFrame, seed: int = 21) -> DataFrame:
    """``total`` goods in even quotas over the merchants, categories in turn.

    ``total`` is a whole-number column (a literal or a scalar subquery).  Ids
    are computed from the quota, not counted.
    """
    numbered = shuffled(merchants.select("user_id"), "user_id", seed, "_m", "_merchants")
    each, rest = F.call_function("div", total, F.col("_merchants")), F.pmod(total, F.col("_merchants"))
    planned = numbered.select(
        F.col("user_id").alias("merch_id"),
        "_m",
        (each * (F.col("_m") - 1) + F.least(F.col("_m") - 1, rest)).alias("_base"),
        (each + F.when(F.col("_m") <= rest, 1).otherwise(0)).alias("_quota"),
    ).where(F.col("_quota") > 0)
    rows = planned.select("merch_id", "_m", "_base", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_quota"))).alias("_n"))
    ring = enumerated(cats.select("caty_id"), "caty_id", "_c")
    size = cats.select(F.count(F.lit(1))).scalar()
    placed = rows.withColumn("_c", F.pmod(F.col("_m") + F.col("_n") - 2, size) + 1)
    return placed.join(ring, "_c").select(
        (F.col("_base") + F.col("_n")).alias("good_id"),
        "merch_id",
        "caty_id",
        product_name(F.col("_base") + F.col("_n"), seed + 1).alias("name"),
    )


def order_count(key: Column | str, seed: int = 31) -> Column:
    """Orders of a customer: nine bands of buyers."""
    out = None
    for bound, least, spread in ORDER_BANDS:
        count = rounded_draw(key, seed + 1, spread, least) if spread else F.lit(least).cast("bigint")
        out = F.when(draw(key, seed) < bound, count) if out is None else out.when(draw(key, seed) < bound, count)
    return out


def orders(users_: DataFrame, goods_: DataFrame, seed: int = 31, cap: int | None = None) -> DataFrame:
    """Orders by customer band, each for a good chosen by hash.

    ``cap`` keeps that many orders of a seeded random order.
    """
    planned = customers(users_).select("user_id", order_count("user_id", seed).alias("_orders")).where(F.col("_orders") > 0)
    rows = planned.select("user_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_orders"))).alias("n"))
    keyed = rows.withColumn("_key", F.col("user_id") * 100 + F.col("n"))
    out = assign_by_hash(keyed, "_key", goods_, "good_id", seed + 2)
    if cap is not None:
        out = out.orderBy(mix("_key", seed + 3), "_key").limit(cap)
    return out.select(F.col("_key").alias("id"), "user_id", "good_id")


def reviews(users_: DataFrame, orders_: DataFrame, seed: int = 41, share: float = REVIEW_SHARE, uniform: bool = False) -> DataFrame:
    """Reviews for a share of the customers' different purchases.

    Ratings 1 and 5 get half the weight of the others unless ``uniform``.
    """
    pairs = orders_.select("user_id", "good_id").distinct().join(customers(users_).select("user_id"), "user_id", "left_semi")
    keyed = pairs.withColumn("_key", F.col("user_id") * 1000003 + F.col("good_id"))
    kept = keyed.where(chance("_key", share, seed))
    rating = pick("_key", 5, seed + 1) + 1 if uniform else rounded_draw("_key", seed + 1, 4, 1)
    comment = F.element_at(F.array(*[F.lit(c) for c in COMMENTS]), (rounded_draw("_key", seed + 2, 4, 0) + 1).cast("int"))
    return kept.select("user_id", "good_id", rating.alias("rating"), comment.alias("comment"))


def per_owner(owners: DataFrame, key: str, least: int, most: int, seed: int = 51) -> DataFrame:
    """``least``..``most`` numbered rows for every owner (0 allowed)."""
    planned = owners.select(key, (pick(key, most - least + 1, seed) + least).alias("_n")).where(F.col("_n") > 0)
    return planned.select(key, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("n"))


def sample_share(df: DataFrame, key: str, share: float, seed: int = 61) -> DataFrame:
    """Each row kept with probability ``share``."""
    return df.where(chance(key, share, seed))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 61) -> DataFrame:
    """``n`` rows at random."""
    return df.orderBy(mix(key, seed), key).limit(n)


def seed_products(ids: DataFrame) -> DataFrame:
    """Product documents of the exact seed for ids 1, 2, ...

    The merchant's name is one shop off its id throughout, as in the seed.
    """
    names = F.array(*[F.lit(f"Товар {c}") for c in SEED_GOODS])
    shops = F.array(*[F.lit(m) for m in SEED_MERCHANTS])
    cats = F.array(*[F.lit(c) for c in SEED_CATEGORIES])
    i = F.col("id")

    def nth(items: Column, at: Column) -> Column:
        return F.element_at(items, (at + 1).cast("int"))

    return ids.select(
        i.alias("good_id"),
        F.concat_ws(" ", nth(names, F.pmod(i - 1, F.lit(10))), i.cast("string")).alias("name"),
        (F.pmod(i, F.lit(3)) + 1).alias("merchant_id"),
        (F.pmod(i, F.lit(5)) + 1).alias("category_id"),
        nth(shops, F.pmod(i - 1, F.lit(3))).alias("merchant_name"),
        nth(cats, F.pmod(i, F.lit(5))).alias("category_name"),
        F.create_map().cast("map<string,string>").alias("attributes"),
        F.array().cast("array<string>").alias("tags"),
    )


def seed_reviews(ids: DataFrame) -> DataFrame:
    """Reviews of the exact seed: ``2 + id % 4`` for each product id.

    The running review number is a closed formula of the product id, so no
    global counter is needed.
    """
    before = F.col("id") - 1
    rest = F.pmod(before, F.lit(4))
    start = before * 2 + F.floor(before / 4) * 6 + F.floor(rest * (rest + 1) / 2)
    rows = ids.select(
        F.col("id").alias("product_id"),
        start.alias("_start"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.pmod("id", F.lit(4)) + 2)).alias("_n"),
    )
    number = F.col("_start") + F.col("_n")
    return rows.select(
        number.alias("review_id"),
        "product_id",
        (F.pmod(number + 1, F.lit(100)) + 1).alias("user_id"),
        (F.pmod(number + 1, F.lit(5)) + 1).alias("rating"),
        F.concat(F.lit("Отзыв "), (number + 1).cast("string")).alias("comment"),
    )


def payload(event_type: Column, ref: Column, other: Column) -> Column:
    """Payload text by event type."""
    shapes = {
        "OrderCreated": F.struct(ref.alias("orderId"), F.lit(99.5).alias("amount"), F.lit("RUB").alias("currency")),
        "OrderPaid": F.struct(ref.alias("orderId"), other.alias("paymentId")),
        "OrderCancelled": F.struct(ref.alias("orderId"), F.lit("user_request").alias("reason")),
        "TrainingBooked": F.struct(other.alias("slotId"), F.lit("ivan").alias("coach")),
        "SubscriptionExpired": F.struct(ref.alias("memberId"), F.lit("gold").alias("plan")),
        "TripCreated": F.struct(F.lit("42").alias("routeId"), F.lit("bus-7").alias("vehicleId")),
        "CrashDetected": F.struct(F.lit("bus-7").alias("vehicleId"), F.lit("high").alias("severity")),
        "BookIssued": F.struct(F.lit("978-5-000").alias("isbn"), ref.alias("readerId")),
        "BookReturned": F.struct(F.lit("978-5-000").alias("isbn"), ref.alias("readerId"), F.lit(0).alias("fineRub")),
    }
    out = None
    for name, shape in shapes.items():
        text = F.to_json(shape)
        out = F.when(event_type == name, text) if out is None else out.when(event_type == name, text)
    return F.coalesce(out, F.lit("{}"))


def business_events(ids: DataFrame, at: Column, seed: int = 71, types: list[str] | None = None, source: str = "feed") -> DataFrame:
    """Envelopes for ids, at times ``at``: one column per envelope field."""

    def token(n: int) -> Column:
        return F.lpad(F.hex(mix("id", seed + n)), 8, "0")

    ref, other = token(1), token(2)
    kind = pick_from(types or PRODUCED, "id", seed)
    return ids.select(
        F.concat_ws("-", token(3), token(4), F.col("id").cast("string")).alias("eventId"),
        kind.alias("eventType"),
        F.concat_ws("-", F.lower(kind), ref).alias("entityId"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.lit(source).alias("source"),
        payload(kind, ref, other).alias("payload"),
        F.lit("1.0").alias("version"),
        F.struct(
            F.concat_ws("-", token(5), F.col("id").cast("string")).alias("correlationId"),
            F.lit("feed-producer").alias("producer"),
            F.lit("json+v1").alias("schemaHint"),
        ).alias("metadata"),
    )


@dataclass(frozen=True)
class Feed:
    """Orders and reviews by tick: three orders and two reviews each, a review for one of the orders made so far.

    Every row is a function of its number, the order behind a review too, so
    any set of ticks gives its own rows without looking at other ticks.
    ``customers`` and ``goods`` are numbered pools (``numbered_pool``).
    """

    customers: tuple[DataFrame, Column]
    goods: tuple[DataFrame, Column]
    start: str
    seed: int = 81

    def _rows(self, ticks: DataFrame, each: int, at: str, number: str) -> DataFrame:
        time = F.lit(self.start).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("tick"))
        rows = ticks.select("tick", time.alias(at), F.explode(F.array(*[F.lit(i) for i in range(each)])).alias("_i"))
        return rows.withColumn(number, F.col("tick") * each + F.col("_i") + 1)

    def _parties(self, rows: DataFrame) -> DataFrame:
        return assign_from(assign_from(rows, "order_id", *self.customers, self.seed), "order_id", *self.goods, self.seed + 1)

    def orders(self, ticks: DataFrame) -> DataFrame:
        return self._parties(self._rows(ticks, 3, "order_ts", "order_id")).select(
            "order_id", "user_id", "good_id", "order_ts",
            ((pick("order_id", 49001, self.seed + 2) + 1000) / 100.0).alias("price"),
        )

    def reviews(self, ticks: DataFrame) -> DataFrame:
        """All reviews of the ticks; a user may review a good more than once here."""
        said = self._rows(ticks, 2, "review_ts", "review_id")
        said = said.withColumn("order_id", pick("review_id", (F.col("tick") + 1) * 3, self.seed + 3) + 1)
        return self._parties(said).select(
            "review_id", "order_id", "user_id", "good_id", (pick("review_id", 5, self.seed + 4) + 1).alias("rating"), "review_ts"
        )


def event_feed(ticks: DataFrame, users_: DataFrame, goods_: DataFrame, start: str, seed: int = 81) -> tuple[DataFrame, DataFrame]:
    """Order and review feed of all ticks at once: a second review of the same good by the same user is skipped."""
    feed = Feed(numbered_pool(customers(users_), "user_id"), numbered_pool(goods_, "good_id"), start, seed)
    return feed.orders(ticks), top_per_group(feed.reviews(ticks), ["user_id", "good_id"], ["review_id"], 1)
