"""Row types of the store, the label set and the registries."""

from __future__ import annotations

CONTEXT = "struct<source_url:string,action:string,action_date:string,action_evidence:string,sections:array<string>,datasets:array<string>,topics:array<string>>"
LABEL = f"struct<name:string,type:string,source:string,chain:string,subtype:string,chain_evidence:string,context:{CONTEXT}>"
FLAGS = ("sanctioned", "is_illicit", "is_exchange", "is_ai_agent")
#: Scalars that the merge takes from the first record that has one.
SCALARS = ("entity_name", "category", "jurisdiction", "license_id", "regulator", "license_status", "sanctions_reference", "source_url", "source_date")
#: A raw record, which is also a record of the store. extras holds every further key by presence.
RECORD = (
    f"address string, chain string, labels array<{LABEL}>, "
    + ", ".join(f"{f} boolean" for f in FLAGS)
    + ", "
    + ", ".join(f"{s} string" for s in SCALARS)
    + ", last_verified string, extras map<string,string>"
)
#: The label set; the order of columns is part of the contract.
LABEL_SET = (
    "chain string, address string, classes array<string>, sources array<string>, origins array<string>, graph_key string, case_broken boolean, "
    "case_provenance string, label_addr_original string, in_included_5 boolean, provenance array<string>"
)
BATCH = "chain string, address string, classes array<string>, anchor_type string, method string, source_url string, source_date string, note string"
# The vocabularies of the store.
CATEGORIES = ("vasp", "exchange_depositor", "mixer", "defi_protocol", "sanctioned", "scam", "personal", "unknown")
LICENCE_STATES = ("active", "revoked", "pending")
ILLICIT_TYPES = ("illicit", "sanctioned", "rugpull", "honeypot", "phishing", "scam", "hack", "exploit", "flash loan attack", "access control", "reentrancy", "oracle issue")
ILLICIT_SOURCES = ("crypto_rekts",)
PRESS_RELEASE = "ofac_press_release"
ACTIONS = {"designation": 2, "change": 1, "removal": 0}
#: Longest values of a record's fields.
LENGTHS = {"address": 256, "chain": 32, "jurisdiction": 8, "license_id": 128, "regulator": 128, "entity_name": 128, "sanctions_reference": 128, "source_url": 512}
LABEL_LENGTHS = {"name": 256, "type": 64, "source": 128, "chain": 32}
