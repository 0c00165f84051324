"""All registered queries of the library and their SQL."""

from trawl.plans import audits, classes, health, ledgers, metrics, site_report, sources, streams, texts, verdicts

MODULES = (site_report, classes, texts, ledgers, metrics, audits, health, sources, streams, verdicts)


def queries():
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql():
    return {k: s for m in MODULES for k, s in m.SQL.items()}
