from fleetvolt.operators import fleet

from helpers import asset_view, rows


def _av(spark):
    return asset_view(spark, [
        (1, "A1", "t1", 7, "Org7", "Solar", "Active"), (2, "A2", "t2", 7, "Org7", "Solar", "Active"),
        (3, "A3", "t3", 8, "Org8", "Solar", "Active"), (4, "A4", "t4", 7, "Org7", "Solar", "Retired"),
        (5, "A5", "t5", 8, "Org8", "Other", "Active"), (6, None, "t6", 8, "Org8", "Solar", "Active")])


def test_active_devices_naming(spark):
    got = rows(fleet.active_devices(_av(spark), "Solar"), "AssetId", "DeviceID", "DeviceName")
    assert got == [(1, "A1", "t1"), (2, "A2", "t2"), (3, "A3", "t3"), (6, None, "t6")]
    ids = rows(fleet.active_device_ids(_av(spark), "Solar"))
    assert ids == [("A1",), ("A2",), ("A3",)]     # NULL ids dropped


def test_org_counts_and_totals(spark):
    av = _av(spark)
    counts = fleet.org_device_counts(av, [7, 8, 9], "Solar").collect()
    assert [(r.OrganizationId, r.DevicesCount) for r in counts] == [(7, 2), (8, 2)]   # count desc, then id
    assert fleet.total_device_count(av, [7, 8], "Solar").first().TotalDevices == 4


def test_empty_org_list(spark):
    av = _av(spark)
    assert fleet.org_device_counts(av, [], "Solar").count() == 0
    assert fleet.org_device_counts(av, None, "Solar").count() == 0
    assert fleet.total_device_count(av, [], "Solar").first().TotalDevices == 0


def test_long_org_list_is_one_set_filter(spark):
    av = _av(spark)
    ids = list(range(2000)) + [7]
    out = fleet.filter_orgs(av, "OrganizationId", organization_ids=ids)
    assert out.count() == 6
    assert "INSET" in out._jdf.queryExecution().optimizedPlan().toString()
