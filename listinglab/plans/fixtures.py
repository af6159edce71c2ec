"""Raw-shaped inputs derived from the driver tables with native Spark expressions.

The driver data set holds no flight or review files, so these views re-shape
TPC-H-like tables into the text formats the listing and review pipelines
read. The work grows with the source tables (every lineitem row becomes a
listing row; every document a review). Joins are left to Catalyst/AQE except
``nation``, whose size is fixed at 25 rows by the TPC-H schema and is
broadcast.

The matching DuckDB expressions live in :mod:`listinglab.plans.oracle`;
they compute the *expected clean values* straight from the source columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_LISTING_COLUMNS
from ..session import table

# ---------------------------------------------------------------------------
# Fixed values used to render raw text (they mirror the source site's text).
DEPARTURE_NAME = "TP Hồ Chí Minh"
DEPARTURE_CODE = "SGN"
PASSENGER_TYPE = "Người lớn"
POLICY_A = "['- Áp dụng hoàn vé mất phí', '- Áp dụng đổi vé mất phí', '- Không áp dụng đổi tên']"
POLICY_N = "['- Áp dụng hoàn vé mất phí', '- Áp dụng đổi vé miễn phí, thu chênh lệch giá', '- Miễn phí chọn ghế']"
POLICY_EMPTY = "[]"
POLICY_BROKEN = "['- Áp dụng hoàn vé"
MONTHS = ["January", "February", "March", "April", "May", "June", "July",
          "August", "September", "October", "November", "December"]
SERVICES = ["Legroom", "Seat comfort", "Customer service"]
# ---------------------------------------------------------------------------

#: Price per ticket: by duration, baggage, fare and place, and a remainder that no feature tells.
PRICE = ("cast(round(l_extendedprice / 10) as bigint) + 20000 * (1 + l_linenumber % 3) + 150 * (l_partkey % 60) "
         "+ if(l_suppkey % 3 = 0, 400 * (20 + 5 * (l_partkey % 3)), 0) + decode(l_returnflag, 'A', 3000, 'N', 9000, 0) + 500 * n_nationkey")
BAD_MOD = 997        # one order in 997 carries one broken field per line
DUP_MOD = 101        # one order in 101 is scraped twice


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal out a scan of few splits (the driver's files are one row group each)
    over the local cores. For these fixtures only: operators take input as it comes."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def _listing_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_tax", "l_returnflag", "l_linestatus"), "l_orderkey")
    o = _spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    # Orders, not their lineitems, move to the customers; of a nation only its key moves along.
    placed = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_orderdate", "c_nationkey")
    return (
        li.join(placed, li.l_orderkey == placed.o_orderkey)
        .drop("o_orderkey")
        .join(p, li.l_partkey == p.p_partkey)
        .drop("p_partkey")
        .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)   # 25 rows by schema
    )


def _fmt_money(x: Column) -> Column:
    thousands = F.concat((x / 1000).cast("bigint").cast("string"), F.lit(","), F.lpad((x % 1000).cast("string"), 3, "0"))
    # Most prices: cheaper than the general form, and the same text.
    return F.concat(F.when(x.between(1000, 999999), thousands).otherwise(F.format_number(x, 0)), F.lit(" VNĐ"))


def listing_columns(b: DataFrame) -> DataFrame:
    """Render the 16 raw text columns (plus ``day``/``route`` file layout keys)."""
    bad = (F.col("l_orderkey") % BAD_MOD) == 0
    kind = F.col("l_linenumber")

    dep_ts = F.timestamp_add("MINUTE", (F.col("l_suppkey") % 12) * 5,
                            F.timestamp_add("HOUR", F.col("l_orderkey") % 24, F.col("o_orderdate")))
    dur_h = 1 + F.col("l_linenumber") % 3
    dur_m = F.col("l_partkey") % 60
    arr_ts = F.timestamp_add("MINUTE", dur_m, F.timestamp_add("HOUR", dur_h, dep_ts))
    scrape_ts = F.timestamp_add("HOUR", F.col("l_suppkey") % 24,
                               F.timestamp_add("DAY", 2 - F.col("l_partkey") % 40, F.col("o_orderdate")))
    fare = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    price = F.expr(PRICE)
    tax = F.expr(f"(({PRICE}) * cast(round(l_tax * 100) as bigint)) div 100")
    total = price + tax
    code = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    flight = F.concat(F.lit("FL"), F.col("l_suppkey").cast("string"))

    ticket_ok = F.concat(F.col("p_brand"), F.lit(" Chuyến bay: "), flight, F.lit(" Hạng vé : "), fare)
    ticket_nomark = F.concat(F.col("p_brand"), F.lit(" "), flight)
    ticket_twice = F.concat(F.col("p_brand"), F.lit(" Chuyến bay: "), flight, F.lit(" Chuyến bay: X Hạng vé : "), fare)
    fmt = "HH:mm dd/MM/yyyy"

    cols = {
        "Departure Location": F.when(bad & (kind == 3), F.lit(DEPARTURE_NAME))
        .otherwise(F.lit(f"{DEPARTURE_NAME} ({DEPARTURE_CODE})")),
        "Departure Time": F.when(bad & (kind == 6), F.lit("soon")).otherwise(F.date_format(dep_ts, fmt)),
        "Arrival Location": F.concat(F.col("n_name"), F.lit(" ("), code, F.lit(")")),
        "Arrival Time": F.date_format(arr_ts, fmt),
        "Flight Duration": F.when(bad & (kind == 5), F.lit("N/A"))
        .otherwise(F.concat(dur_h.cast("string"), F.lit(" giờ "), dur_m.cast("string"), F.lit(" phút"))),
        "Aircraft Type": F.concat(F.lit("Máy bay: "), F.col("p_type"),
                                  F.when(F.col("p_size") > 40, F.lit(" (máy bay lớn)")).otherwise(F.lit(""))),
        "Ticket Price": F.when(bad & (kind == 1), ticket_nomark)
        .when(bad & (kind == 4), ticket_twice).otherwise(ticket_ok),
        "Passenger Type": F.lit(PASSENGER_TYPE),
        "Number of Tickets": F.lit("1"),
        "Price per Ticket": F.when(bad & (kind == 2), F.lit("abc VNĐ")).otherwise(_fmt_money(price)),
        "Taxes & Fees": _fmt_money(tax),
        "Total Price": _fmt_money(total),
        "Carry-on Baggage": F.when(F.col("l_linenumber") % 4 == 0, F.lit("2 x 9kg"))
        .when(F.col("l_linenumber") % 4 == 1, F.lit("7kg"))
        .when(F.col("l_linenumber") % 4 == 2, F.lit("10kg")),
        "Checked Baggage": F.when(F.col("l_suppkey") % 3 == 0,
                                  F.concat((20 + 5 * (F.col("l_partkey") % 3)).cast("string"), F.lit("kg")))
        .when(F.col("l_suppkey") % 3 == 1, F.lit("Vui lòng chọn ở bước tiếp theo")),
        "Refund Policy": F.when(bad, F.lit(POLICY_BROKEN))
        .when(F.col("l_returnflag") == "A", F.lit(POLICY_A))
        .when(F.col("l_returnflag") == "N", F.lit(POLICY_N))
        .when(F.col("l_linestatus") == "O", F.lit(POLICY_EMPTY)),
        "Scrape Time": F.date_format(scrape_ts, "yyyy-MM-dd HH:mm:ss"),
    }
    layout = {
        "day": F.date_format(F.trunc(scrape_ts, "year"), "dd_MM_yyyy"),
        "route": F.concat(F.lit(f"{DEPARTURE_CODE}_to_"), code),
    }
    return b.select(*[v.alias(k) for k, v in cols.items()], *[v.alias(k) for k, v in layout.items()])


def raw_listings(spark: SparkSession, sf_dir: str, with_layout: bool = False) -> DataFrame:
    """Raw listing rows (all strings, as scraped), one per lineitem plus
    re-scraped duplicates of one order in 101."""
    b = _listing_base(spark, sf_dir)
    copies = F.when((F.col("l_orderkey") % DUP_MOD) == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = listing_columns(b.withColumn("_copy", F.explode(copies)))
    return rows if with_layout else rows.select(*[F.col(f"`{c}`") for c in RAW_LISTING_COLUMNS])


# ------------------------------------------------------------------ reviews

def _month_name(m: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in MONTHS]), m)


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw review rows from documents (left join labels): Rating, Title,
    Full Review, Information, Service Ratings, Airline (= source) and the
    label columns."""
    d = _spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id")
    lb = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lb, "doc_id", "left")
    k = F.col("doc_id")
    rating = F.when(k % 97 == 5, F.lit("no rating")).otherwise(
        F.concat((1 + k % 5).cast("string"), F.lit(".0 of 5 bubbles")))
    info = (F.when(k % 10 == 3, F.lit(None).cast("string"))
            .when(k % 89 == 7, F.lit("Date of travel: Smarch 2024"))
            .otherwise(F.concat(F.lit("Date of travel: "), _month_name((k % 12 + 1).cast("int")), F.lit(" 2024"))))
    svc_name = F.element_at(F.array(*[F.lit(x) for x in SERVICES]), (k % 3 + 1).cast("int"))
    services = F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(
        F.lit("[{'Service Rating': '"), (1 + k % 5).cast("string"), F.lit(".0 of 5 bubbles', 'Service Info': 'Legroom'}, "),
        F.lit("{'Service Rating': '"), (1 + (k / 5).cast("bigint") % 5).cast("string"),
        F.lit(".0 of 5 bubbles', 'Service Info': '"), svc_name, F.lit("'}]")))
    return j.select(
        k.alias("doc_id"),
        rating.alias("Rating"),
        F.substring_index("text", "\n", 1).alias("Title"),
        F.col("text").alias("Full Review"),
        info.alias("Information"),
        services.alias("Service Ratings"),
        F.col("source").alias("Airline"),
        "quality", "toxic",
    )


# --------------------------------------------------------------------- info

def raw_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 9-line key/value text per supplier (``source``, ``text``)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
    k = F.col("s_suppkey")

    def bub(x: Column) -> Column:
        return F.concat(x.cast("string"), F.lit(".0 of 5 bubbles"))

    mention = F.when(k % 7 == 0, F.lit("[]")).otherwise(F.concat(
        F.lit("['budget airline', 'hub "), F.col("n_name"), F.lit("', 'route "), (k % 13).cast("string"), F.lit("']")))
    attrs = F.when(k % 11 == 0, F.lit("{}")).otherwise(F.concat(
        F.lit("{'Legroom': '"), bub(1 + k % 5), F.lit("', 'In-flight entertainment (WiFi, TV, movies)': '"),
        bub(1 + k % 3), F.lit("', 'Cleanliness': '"), bub(1 + k % 4), F.lit("'}")))
    ratings = F.concat(
        F.lit("{'Excellent': '"), F.format_number(k * 37 % 5000, 0), F.lit("', 'Good': '"),
        F.format_number(k * 53 % 3000, 0), F.lit("', 'Terrible': '"), F.format_number(k * 101 % 9000 + 1000, 0), F.lit("'}"))
    text = F.concat(
        F.lit("Name: "), F.col("s_name"), F.lit("\n"),
        F.lit("Phone: 011 84 "), (1900 + k % 100).cast("string"), F.lit(" "), (k * 37 % 10000).cast("string"), F.lit("\n"),
        F.lit("Address: Headquarters: "), k.cast("string"), F.lit(" Street, "), F.col("n_name"), F.lit(" Vietnam\n"),
        F.lit("Website: http://www.s"), k.cast("string"), F.lit(".example.com/\n"),
        F.lit("Average Rating: "), F.format_string("%.1f", (1 + (k % 9) / 2.0)), F.lit("\n"),
        F.lit("Total Review: "), F.format_number(k * 37 + 100, 0), F.lit(" reviews\n"),
        F.lit("Popular Mention: "), mention, F.lit("\n"),
        F.lit("Attributes: "), attrs, F.lit("\n"),
        F.lit("Total Rating: "), ratings, F.lit("\n"),
    )
    return j.select(F.col("s_name").alias("source"), text.alias("text"))


# -------------------------------------------------------------- saved pages

def _escaped(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return F.coalesce(c, F.lit(""))


def _html(template: str, **parts: Column) -> Column:
    """A template with ``{name}`` places; the parts are escaped unless their name begins with ``raw_``."""
    pieces, rest = [], template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [F.lit(before), parts[name] if name.startswith("raw_") else _escaped(parts[name])]
    return F.concat(*pieces, F.lit(rest))


def _joined_html(items: Column) -> Column:
    return F.coalesce(F.array_join(items, ""), F.lit(""))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail page for each raw listing (page_id, html): four tables, the price cell with a table of its own."""
    from ..functions.parsing import policy_list

    raw = raw_listings(spark, sf_dir)
    c = {n: F.col(f"`{n}`") for n in raw.columns}
    policy = F.transform(policy_list(c["Refund Policy"]), lambda x: F.concat(F.lit('<tr class="r"><td><i>'), _escaped(x), F.lit("</i><br></td></tr>")))
    html = _html(
        "<html><body><div id='d' class=\"flight\"><table border=0 class='t'><tbody><tr><td><p class=\"a\">{dl}</p><p>&nbsp;{dt}</p></td>"
        "<td><p>{fd}<p><img src='x.png'>{at}</td><td><p>{al}</p> <p>{arr}</p></td><td><div><table><tr><td>Total</td><td>{tp} (1 &gt; 0)</td></tr></table></div></td>"
        "</tr></table><table><tr><th>Type</th></tr><tr><td>{pt}</td><td>{nt}</td><td>{ppt}</td><td>{tf}</td><td><b>{total}</b></td></tr></table>"
        "<table class='bags'><tbody><tr><td>Bags</td></tr><tr><td>Cabin</td><td>{carry}</td></tr><tr><td>Hold</td><td>{checked}</td></tr></tbody></table>"
        "<table><tbody><tr><td>Rules</td></tr>{raw_policy}</tbody></table></div></body></html>",
        dl=c["Departure Location"], dt=c["Departure Time"], al=c["Arrival Location"], arr=c["Arrival Time"], fd=c["Flight Duration"], at=c["Aircraft Type"],
        tp=c["Ticket Price"], pt=c["Passenger Type"], nt=c["Number of Tickets"], ppt=c["Price per Ticket"], tf=c["Taxes & Fees"], total=c["Total Price"],
        carry=c["Carry-on Baggage"], checked=c["Checked Baggage"], raw_policy=_joined_html(policy))
    return raw.select(F.xxhash64(*c.values()).alias("page_id"), html.alias("html"), F.col("`Scrape Time`"))


#: Reviews on a page.
PAGE_REVIEWS = 8


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of eight reviews (page_id, html), in the order of doc_id."""
    r = raw_reviews(spark, sf_dir)
    k = F.col("doc_id")

    def bubble(x: Column) -> Column:
        return F.concat(x.cast("string"), F.lit(".0 of 5 bubbles"))

    name = F.element_at(F.array(*[F.lit(x) for x in SERVICES]), (k % 3 + 1).cast("int"))
    services = F.when(k % 4 == 0, F.lit("")).otherwise(_html(
        '<div class="JxiyB f"><div class="msVPq"><svg d="1" class="UctUV d H0"><title>{one}</title></svg><div class="biGQs _P pZUbB osNWb">Legroom</div></div>'
        '<div id=x class="msVPq"><svg class="UctUV d H0">{two}</svg><div class="biGQs _P pZUbB osNWb"><div>{name}</div></div></div></div>',
        one=bubble(1 + k % 5), two=bubble(1 + (k / 5).cast("bigint") % 5), name=name))
    block = _html(
        '<div data-k="1" class="lwGaE A"><div class="head"><svg class="UctUV d H0"><title>{rating}</title></svg></div>'
        '<div class="biGQs _P fiohW uuBRH"><div><a href="/r">{title}</a></div></div><div><span class="JguWG"><span>{review}</span></span></div>'
        '<div class="biGQs _P pZUbB ncFvv osNWb">{info}</div>{raw_services}<hr></div>',
        rating=F.col("Rating"), title=F.col("Title"), review=F.col("`Full Review`"), info=F.col("Information"), raw_services=services)
    pages = r.select(F.expr(f"doc_id div {PAGE_REVIEWS}").alias("page_id"), k, block.alias("block")).groupBy("page_id").agg(
        F.array_sort(F.collect_list(F.struct("doc_id", "block"))).alias("b"))
    return pages.select("page_id", F.concat(F.lit("<html><head><title>Reviews</title></head><body>"), F.array_join("b.block", "\n"), F.lit("</body></html>")).alias("html"))


def info_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page for each supplier (page_id, html) with the fields of its info record."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)   # 25 rows by schema
    k = F.col("s_suppkey")
    mention = F.when(k % 7 == 0, F.lit("")).otherwise(_html(
        "<span class='_T'>budget airline</span><span class=\"_T\">hub {n}</span><span class='_T' id=r>route {r}</span>", n=F.col("n_name"), r=(k % 13).cast("string")))

    def attribute(name: str, mod: int) -> Column:
        return _html('<div class="HWAlD TQNLQ"><span class="exvvN">' + name + '</span><div><span class="RkhSR">{v}</span></div></div>', v=(1 + k % mod).cast("string"))

    def total(name: str, value: Column) -> Column:
        return _html('<div class="jxnKb"><div class="Ygqck o W q">' + name + '</div><div class="biGQs _P fiohW biKBZ osNWb">{v}</div></div>', v=F.format_number(value, 0))

    attributes = F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(attribute("Legroom", 5), attribute("Food &amp; drink", 3), attribute("Cleanliness", 4)))
    totals = F.concat(total("Excellent", k * 37 % 5000), total("Good", k * 53 % 3000))
    html = _html(
        '<html><body><div class="jIkPg G u"><h1>{name}</h1></div><div class="bOZAZ VNlYD">011 84 {phone}</div><div class="biGQs _P pZUbB W hmDzD">{k} Street, {n} Vietnam</div>'
        '<div class="jWfod u"><div><a href="tel:{k}">Call</a></div><a class=w href="http://www.s{k}.example.com/?a=1&amp;b=2">Site</a></div><span class="ammfn">{rating}</span>'
        '<span class="SSkub">{total} reviews</span><div class="TuqGj"><div>{raw_mention}</div></div>{raw_attributes}{raw_totals}</body></html>',
        name=F.col("s_name"), phone=(1900 + k % 100).cast("string"), k=k.cast("string"), n=F.col("n_name"), rating=F.format_string("%.1f", 1 + (k % 9) / 2.0),
        total=F.format_number(k * 37 + 100, 0), raw_mention=mention, raw_attributes=attributes, raw_totals=totals)
    return j.select(k.alias("page_id"), html.alias("html"))
