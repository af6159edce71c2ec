"""Golden pair: one airline key/value info file -> INFO, MENTION, RATING,
ATTRIBUTE (expected values copied from the source's cleaned outputs)."""

from pyspark.sql import functions as F

from listinglab.operators.reviews import info_tables, parse_info

VJ = (
    "Name: VietJetAir\n"
    "Phone: 011 84 1900 1886\n"
    "Address: Headquarters: 530 Nhat Tao, District 11, Ho Chi Minh City Vietnam\n"
    "Website: http://www.vietjetair.com/\n"
    "Average Rating: 2.0\n"
    "Total Review: 6,909 reviews\n"
    "Popular Mention: ['budget airline', 'chiang rai', 'low cost airline', 'bad reviews', 'low budget']\n"
    "Attributes: {'Legroom': '2.5 of 5 bubbles', 'Seat comfort': '2.5 of 5 bubbles', "
    "'In-flight entertainment (WiFi, TV, movies)': '1.5 of 5 bubbles', 'Onboard Experience': '2.5 of 5 bubbles', "
    "'Customer service': '2.5 of 5 bubbles', 'Value for money': '2.5 of 5 bubbles', 'Cleanliness': '3.0 of 5 bubbles', "
    "'Check-in and boarding': '2.5 of 5 bubbles'}\n"
    "Total Rating: {'Excellent': '632', 'Good': '948', 'Average': '731', 'Poor': '573', 'Terrible': '4,035'}\n"
)
EMPTY = "Name: Nobody\nPhone: 1\nPopular Mention: []\nAttributes: {}\nTotal Rating: {}\n"


def test_info_golden(spark):
    df = spark.createDataFrame([("a_vj.txt", VJ), ("b_empty.txt", EMPTY)], "source string, text string")
    t = info_tables(parse_info(df))
    info = {r["name"]: r for r in t["info"].collect()}
    vj = info["VietJetAir"]
    assert vj["phone"] == "011 84 1900 1886"
    assert vj["address"] == "530 Nhat Tao, District 11, Ho Chi Minh City Vietnam"
    assert vj["website"] == "http://www.vietjetair.com/"
    assert vj["averating_rating"] == 2.0 and vj["total_review"] == 6909 and vj["airline_id"] == 0
    assert info["Nobody"]["airline_id"] == 1 and info["Nobody"]["address"] is None

    mentions = t["mention"].where("airline_id = 0").select("popular_mention").collect()
    assert [r[0] for r in mentions] == ["budget airline", "chiang rai", "low cost airline", "bad reviews", "low budget"]
    # empty list -> one NULL mention row (explode_outer), empty maps -> no rows
    assert [tuple(r) for r in t["mention"].where("airline_id = 1").collect()] == [(None, 1)]
    assert t["rating"].where("airline_id = 1").count() == 0
    assert t["attribute"].where("airline_id = 1").count() == 0

    ratings = {r["rate_name"]: r["count"] for r in t["rating"].where("airline_id = 0").collect()}
    assert ratings == {"Excellent": "632", "Good": "948", "Average": "731", "Poor": "573", "Terrible": "4,035"}
    attrs = {r["attribute_name"]: r["rating"] for r in t["attribute"].where("airline_id = 0").collect()}
    assert len(attrs) == 8
    assert attrs["In-flight entertainment (WiFi, TV, movies)"] == 1.5 and attrs["Cleanliness"] == 3.0
