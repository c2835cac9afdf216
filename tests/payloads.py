"""Hand-made landed pages in the shapes of the source API (values are ours)."""
import json

PROJECT_PAGE_0 = {"projects": {
    "P1": {"id": "P1", "project_name": "Water One", "countryshortname": "Kenya",
           "regionname": "Eastern Africa", "totalamt": "1000000", "curr_ibrd_commitment": "0",
           "idacommamt": "1000000", "grantamt": "0",
           "boardapprovaldate": "2020-05-14T00:00:00Z", "closingdate": "2025-06-30",
           "envassesmentcategorycode": "B", "borrower": "Ministry of Water, Sanitation",
           "impagency": "A,,B ",
           "major_sectors": [
               {"major_sector": {"major_sector_code": "WWX", "major_sector_name": "Water",
                                 "sectors": [
                                     {"sector_name": "Sanitation ", "sector_code": "WWA", "sector_percent": "60"},
                                     {"sector_name": "Water Supply", "sector_code": "WWC", "sector_percent": "40"}]}},
               {"major_sector": {"major_sector_code": "EEX", "major_sector_name": "Energy"}}]},
    "P2": {"id": "P2", "project_name": "Roads", "countryshortname": "Chad", "regionname": "Chad",
           "totalamt": "2500.005", "boardapprovaldate": "junk", "closingdate": "",
           "major_sectors": "not a list"},
    "P3": {"id": "P3", "project_name": "Global", "regionname": "World"},
    "P4": {"id": "P4", "project_name": "Misc", "countryshortname": "Other", "regionname": "Other"},
    "P5": {"id": "P5", "project_name": "Andes", "countryshortname": "Peru", "regionname": "Other",
           "lendprojectcost": "x"},
}}

PROJECT_PAGE_1 = {"projects": {
    "P1": dict(PROJECT_PAGE_0["projects"]["P1"], project_name="Water One (again)"),
    "P6": {"id": "P6", "project_name": "Sahel", "countryshortname": "Chad", "regionname": "Western Africa",
           "major_sectors": [
               {"major_sector": {"major_sector_code": "WWX", "major_sector_name": "Water Sector",
                                 "sectors": [{"sector_name": "Sanitation alt", "sector_code": "WWA"}]}}]},
}}

LONG_TITLE = "T" * 300

DOC_PAGE_2020_0 = {"total": "1500", "documents": {
    "D10": {"id": "10", "projectid": "P1", "docty": "Report", "docna": {"0": {"docna": "Doc ten"}},
            "authors": {"0": {"author": "AB"}, "1": {"author": "CD"}},
            "docdt": "2026-12-31T23:30:00Z", "volnb": "1.5", "theme": "x, y,z",
            "subsc": "Other Industry,Power", "sectr": {"0": {"sector": "Energy"}, "1": {"sector": " "}},
            "count": "Kenya,Chad"},
    "D11": {"id": "11", "projectid": "", "theme": "dropped"},
    "D12": {"id": "12", "projectid": "P999", "subsc": "Mining Only", "theme": "t12",
            "sectr": {"0": {"sector": "Mining"}}},
    "facets": {},
}}

DOC_PAGE_2020_1 = {"total": "1500", "documents": {
    "D10": {"id": "10", "projectid": "P1", "docty": "Report v2", "docna": {"0": {"docna": "Doc ten"}},
            "authors": {"0": {"author": "AB"}, "1": {"author": "CD"}},
            "docdt": "2026-12-31T23:30:00Z", "volnb": "1.5", "theme": "a,,b",
            "subsc": "Other industry", "sectr": {"0": {"sector": "Energy"}, "1": {"sector": " "}},
            "count": "kenya,Peru"},
    "D13": {"id": "13", "projectid": "P2", "authors": "plain author", "docna": {"1": {"docna": "no zero"}},
            "volnb": "x", "display_title": LONG_TITLE, "sectr": "not a map",
            "theme": "\tTabbed ,Trail,", "count": "Other"},
    "facets": {},
}}

DOC_PAGE_2021_0 = {"total": "1", "documents": {
    "D14": {"id": "14", "projectid": "P5", "docdt": "2021-03-04", "volnb": "1",
            "subsc": "Other Industry"},
}}


def write_pages(path):
    lines = [
        {"source": "projects", "year": None, "offset": 0, "body": PROJECT_PAGE_0},
        {"source": "projects", "year": None, "offset": 1000, "body": PROJECT_PAGE_1},
        {"source": "documents", "year": 2020, "offset": 0, "body": DOC_PAGE_2020_0},
        {"source": "documents", "year": 2020, "offset": 1000, "body": DOC_PAGE_2020_1},
        {"source": "documents", "year": 2021, "offset": 0, "body": DOC_PAGE_2021_0},
    ]
    with open(path, "w") as f:
        for line in lines:
            f.write(json.dumps(line) + "\n")
    return path
