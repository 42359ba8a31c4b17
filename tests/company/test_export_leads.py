"""The export of leads parses each payload once and sorts what is stored."""

from prospectspark.operators import ads

RAW = [
    (1, "indeed", '{"company": "Z", "title": "Leiter", "location": "Kiel", "isRemote": true}'),
    (2, "stepstone", '{"company": "A", "title": "Leiter", "city": "Kiel"}'),
    (3, "indeed", '{"company": "B", "title": "Leiter", "location": "Berlin"}'),
    (4, "indeed", "no json"), (5, "indeed", None),
]


def test_payloads_are_parsed_once_below_the_filters(spark):
    leads = ads.build_leads(ads.unify_job_sources(spark.createDataFrame(RAW, "id int, source string, payload string")))
    plan = leads.filter("in_target and excluded is null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") <= 1
    found = ads.export_leads(leads)
    assert [(r.id, r.company, r.city, r.remote) for r in found.collect()] == [(2, "A", "Kiel", False), (1, "Z", "Kiel", True)]
    assert "arse" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [r.id for r in ads.export_leads(leads, everything=True, remote_only=True).collect()] == [1]
