"""Hand-made product snapshots (NDJSON) covering the golden rows and edge lines."""

import gzip
import json
import os


def _csv(**channels):
    out = [None] * 18
    for k, v in channels.items():
        out[int(k[1:])] = v
    return out


A1 = {
    "_airbyte_raw_id": "r-a1-1",
    "_airbyte_extracted_at": "2024-03-01T01:00:00Z",
    "_airbyte_data": {
        "asin": "A1", "title": "Widget", "brand": "Acme", "binding": "Toy", "color": "red",
        "manufacturer": "Acme Co", "productGroup": "Toys", "productType": 5,
        "availabilityAmazon": 0, "websiteDisplayGroup": "toy_display_on_website",
        "websiteDisplayGroupName": "Toys",
        "csv": _csv(c0=[0, 1000, 1440, -1], c1=None, c2=[], c3=[0, 50, 60, -1, 120], c4=[0, 1],
                    c16=[0, 45], c17=[0, 10, 30, 11]),
        "offers": [{"offerId": "O1", "sellerId": "S1", "isPrime": True, "isFBA": False,
                    "condition": "New", "isShippable": True, "isMAP": False, "shipping": 499,
                    "offerCSV": "0,1999,1440,-1,2880,0,4320,50000,5760"}],
        "aPlus": [{"module": [{"image": ["i0", "i1"], "imageAltText": ["alt0"], "text": ["hello"],
                               "video": []},
                              {"image": [], "imageAltText": [], "text": [], "video": []}]}],
        "videos": [{"creator": "c", "duration": 30, "image": "thumb", "name": "v1", "title": "t1",
                    "url": "u1"},
                   {"creator": "c", "duration": -1, "image": None, "name": None, "title": "none",
                    "url": None}],
        "categoryTree": [{"catId": 10, "name": "Root"}, {"catId": 20, "name": "Leaf"}],
        "buyBoxSellerIdHistory": ["0", "S1", "10", ""],
        "monthlySold": 9,
        "monthlySoldHistory": [0, 5, 1440, 7, 50000, 9, 90000],
    },
}

# Edge products.
A2 = {  # rank 0, rating 60, a text value inside csv, offers null
    "_airbyte_raw_id": "r-a2-1", "_airbyte_extracted_at": "2024-03-01T02:00:00Z",
    "_airbyte_data": {"asin": "A2", "brand": "Bee",
                      "csv": _csv(c0=[100, "abc"], c3=[100, 0], c16=[100, 60]),
                      "offers": None, "buyBoxSellerIdHistory": "100,S9,200,S2"},
}
A3 = {  # offers [], offer without id, empty csv offer
    "_airbyte_raw_id": "r-a3-1", "_airbyte_extracted_at": "2024-03-01T03:00:00Z",
    "_airbyte_data": {"asin": "A3", "offers": [
        {"sellerId": "S7", "offerCSV": "0,100"},
        {"offerId": "O9", "sellerId": "S8", "offerCSV": ""}]},
}
NO_ASIN = {
    "_airbyte_raw_id": "r-x-1", "_airbyte_extracted_at": "2024-03-01T04:00:00Z",
    "_airbyte_data": {"title": "no asin", "csv": _csv(c3=[0, 5])},
}
# A1 loaded again the same day (later extract) with a changed price and rank.
A1_SAME_DAY = json.loads(json.dumps(A1))
A1_SAME_DAY["_airbyte_raw_id"] = "r-a1-2"
A1_SAME_DAY["_airbyte_extracted_at"] = "2024-03-01T05:00:00Z"
A1_SAME_DAY["_airbyte_data"]["csv"][0] = [0, 1100, 1440, -1, 2880, 1200]
# A1 on the next day: brand change.
A1_NEXT_DAY = json.loads(json.dumps(A1))
A1_NEXT_DAY["_airbyte_raw_id"] = "r-a1-3"
A1_NEXT_DAY["_airbyte_extracted_at"] = "2024-03-02T01:00:00Z"
A1_NEXT_DAY["_airbyte_data"]["brand"] = "Acme2"
A1_NEXT_DAY["_airbyte_data"]["csv"][3] = [0, 40]


def write_feed(root, loads):
    """loads: {subfolder: [records or raw strings]} -> gzip NDJSON files."""
    for sub, recs in loads.items():
        d = os.path.join(root, sub)
        os.makedirs(d, exist_ok=True)
        with gzip.open(os.path.join(d, "part-0.jsonl.gz"), "wt") as f:
            for r in recs:
                f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")
        # a file that must be ignored by the name pattern
        with open(os.path.join(d, "notes.txt"), "w") as f:
            f.write('{"_airbyte_data": {"asin": "IGNORED"}}\n')
