import pytest

from kinfold.functions.text import normalized

SCHEMA = "entity_id string, business_name string, business_address string, country string"
CASES = [
    ("Quillmark Harbour Studio, LLC", "47 Juniper Circle, Fairmount, Tennessee", "US", "quillmark harbour studio", "47 juniper circle fairmount tn", "47", "", "tn"),
    ("Orbelin Vakt0 Inc.", "30415 Marrowhill Dr., Pinecrest Village, MD", "US", "orbelin vakto", "30415 marrowhill drive pinecrest village md", "30415", "", "md"),
    ("www.lumenraft.com", "Flat 208, Opp Silver Oak, తెలంగాణ", "India", "lumenraft", "flat 208 opposite silver oak tg", "208", "", "tg"),
    ("Sarvika Instruments Pvt Ltd", "22/7 Lotus Court, Trivandrum, Kerala 695099", "India", "sarvika instruments", "22 7 lotus court thiruvananthapuram kl 695099", "7 22", "695099", "kl"),
    ("Menuiserie Valcourt SARL", "9bis av. du Marché Élégant, 69002 Lyon", "France", "menuiserie valcourt", "9 bis avenue du marche elegant 69002 lyon", "9", "69002", ""),
    ("The And", "¼ street, N/A", "x", "the and", "1 4 street", "1 4", "", ""),
    ("r0botics 5k P.C. & Sons 7719482206", None, None, "robotics 5k sons", "", "", "", ""),
    ("लिमिटेड कंपनी", "2-2ND Floor, 000", "India", "limited company", "2 floor 0", "0 2", "", ""),
    ("", "  ", "us", "", "", "", "", ""),
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(str(i), n, a, c) for i, (n, a, c, *_) in enumerate(CASES)], SCHEMA)
    return {r["entity_id"]: r for r in normalized(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_normalized(rows, i):
    r = rows[str(i)]
    assert (r["name_core"], r["addr_norm"], r["addr_nums"], r["postcode"], r["state"]) == CASES[i][3:]
