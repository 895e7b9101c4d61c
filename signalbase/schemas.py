"""Schemas of landed snapshots, nested records and stored tables."""

from __future__ import annotations

# ---- landed snapshots ----
DIRECTORY = ("name string, industry string, subindustry string, long_description string, one_liner string, "
             "team_size string, url string, cb_url string, slug string")
SPACES = "id string"
BOARD_A = "jobs array<struct<company_name:string,publication_date:string,url:string>>"
BOARD_B = ("data array<struct<title:string,tags:array<string>,created_at:double,company_name:string,"
           "remote:boolean,url:string>>")
BOARD_C = "jobs array<struct<jobTitle:string,pubDate:string,companyName:string,url:string>>"
JOB_FEED_ITEM = "title string, pubDate string, link string"
NEWS_ITEM = ("title string, pubDate string, link string, description string, published string, "
             "updated string")
NEWS_ENTRY = ("title string, published string, updated string, "
              "link array<struct<_href:string,_rel:string>>, summary string, pubDate string")
PAPER_ENTRY = "id string, title string, summary string, published string, author array<struct<name:string>>"
PAGES = "url string, html string"
REPO_STATS = "owner string, repo string, stars int"
RESPONSES = "doc_id bigint, tier int, status int, body string"

# ---- nested records ----
SOURCE = "source struct<name:string,url:string>"
RECORDS = {
    "startups": f"schemaVersion string, recordType string, {SOURCE}, "
                "content struct<entityName:string,data:struct<employeeCount:int>>, collectedAt string",
    "products": f"schemaVersion string, recordType string, {SOURCE}, "
                "content struct<startupName:string,pricingModel:string>, collectedAt string",
    "research_papers": "schemaVersion string, recordType string, content struct<title:string,"
                       "authors:array<string>,paper_url:string,github_url:string,github_stars:int,"
                       "published_date:string>",
    "jobs": "schemaVersion string, recordType string, content struct<company:string,date:string,"
            "is_remote:boolean,role_family:string>, source_url string",
    "news": f"schemaVersion string, recordType string, {SOURCE}, "
            "content struct<title:string,text:string,published_date:string>, collectedAt string",
}
RECORD_TYPES = {
    "startups": "STARTUP", "products": "PRODUCT", "research_papers": "RESEARCH_PAPER", "jobs": "JOB",
    "news": "NEWS",
}

# ---- stored tables ----
TABLES = {
    "startups": "id bigint, hash_key string, entity_name string, employee_count int, source_name string, "
                "source_url string, collected_at string, raw_payload string",
    "products": "id bigint, hash_key string, startup_name string, pricing_model string, source_name string, "
                "source_url string, collected_at string, raw_payload string",
    "research_papers": "id bigint, hash_key string, title string, authors string, paper_url string, "
                       "github_url string, github_stars int, published_date string, raw_payload string",
    "jobs": "id bigint, hash_key string, company string, date string, is_remote boolean, role_family string, "
            "source_url string, raw_payload string",
    "news": "id bigint, hash_key string, title string, full_text string, source_name string, "
            "source_url string, published_date string, collected_at string, raw_payload string",
    "entity_mapping_logs": "id bigint, raw_name string, canonical_name string, method string, "
                           "confidence double, resolved_at timestamp",
}
