"""Queries of times, phones, personal data and state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderflow.catalog import checks as K
from orderflow.catalog.fixtures import KEY, VECTOR, Inputs
from orderflow.catalog.registry import query, table
from orderflow.catalog.shapes import complete_orders, stored_orders
from orderflow.functions import codes
from orderflow.functions.phones import clean_phone
from orderflow.functions.privacy import decrypt, encrypt, stable_id
from orderflow.operators import dedupe, phones, privacy, state, timefill
from orderflow.sources.scratch import new_folder
from orderflow.sources.writers import write_snapshot

table("filled_events", K.filled("event_times", "InvoiceDate", "StoreCode", "Enriched_Order_Time", "Header_Id"))


@query("q_time_fill", "select event_id, filled_time Enriched_Order_Time from filled_events")
def time_fill(x: Inputs) -> DataFrame:
    return timefill.fill_times(x.event_times).select("event_id", "Enriched_Order_Time")


@query("q_time_carry", """
select distinct InvoiceDate invoice_date, StoreCode store, carried last_time from (
 select *, last_value(carried) over (partition by InvoiceDate, StoreCode order by (Enriched_Order_Time is null),
  Enriched_Order_Time rows between unbounded preceding and unbounded following) final from filled_events) f
where carried is not distinct from final""")
def time_carry(x: Inputs) -> DataFrame:
    return timefill.last_times(x.event_times, "Enriched_Order_Time", "InvoiceDate", "StoreCode").toDF(
        "invoice_date", "store", "last_time")


_PHONES_SQL = f"""
select *, {K.cleaned_phone('raw_phone')} cleaned from (
 select *, count(*) over (partition by raw_phone, phone_day) daily from (
  select OrderId, case when o_custkey % 6 = 0 then '9 123456780' else PhoneNo end raw_phone,
   strftime(cast(date_trunc('month', o_orderdate) as date), '%Y/%m/%d') phone_day from raw_orders join (
   select o_orderkey ok, o_orderdate from orders) o on ok = o_orderkey) a) b"""
table("phone_rows", _PHONES_SQL)
_LONG = "regexp_full_match(cleaned, '91[6789][0-9]{10}')"
_VALID = f"coalesce(daily < 4 and ((length(cleaned) = 10 and cleaned[1] in ('9', '8', '7', '6')) or {_LONG}), false)"
_KEPT = f"coalesce(case when daily < 4 and {_LONG} then substr(cleaned, 3) else cleaned end, 'xxxxxxxxxx')"


def phone_rows(x: Inputs) -> DataFrame:
    """Orders with a feed number for some and months as days, so that numbers repeat on a day."""
    days = x.table("orders").select(F.col("o_orderkey").alias("ok"),
                                    F.date_format(F.trunc("o_orderdate", "month"), "yyyy/MM/dd").alias("InvoiceDate"))
    orders = x.headers.drop("InvoiceDate").withColumns({
        "Header_Id": F.col("OrderId"), "MobileNo": F.when(F.col("o_custkey") % 6 == 0, "9 123456780")})
    return orders.join(days, F.col("ok") == F.col("o_orderkey")).select("Header_Id", "OrderId", "MobileNo", "PhoneNo",
                                                                      "InvoiceDate")


@query("q_phone_daily_count", "select OrderId, raw_phone, phone_day, daily from phone_rows")
def phone_daily_count(x: Inputs) -> DataFrame:
    rows = phones.validate_phones(phone_rows(x))
    return rows.select("OrderId", F.col(phones.RAW_PHONE).alias("raw_phone"), F.col("InvoiceDate").alias("phone_day"),
                       F.col(phones.DAILY).alias("daily"))


@query("q_phone_clean", f"select o_orderkey, {K.cleaned_phone('PhoneNo')} cleaned from raw_orders")
def phone_clean(x: Inputs) -> DataFrame:
    return x.headers.select("o_orderkey", clean_phone(F.col("PhoneNo")).alias("cleaned"))


@query("q_phone_validate", f"select OrderId, {_KEPT} mobile_number, {_VALID} valid from phone_rows")
def phone_validate(x: Inputs) -> DataFrame:
    return phones.validate_phones(phone_rows(x)).select("OrderId", F.col(phones.CLEAN).alias("mobile_number"),
                                                        F.col(phones.VALID).alias("valid"))


@query("q_phone_strict", f"""
select OrderId, coalesce(daily < 4 and regexp_full_match(cleaned, '[6-9][0-9]{{9}}'), false) valid from phone_rows""")
def phone_strict(x: Inputs) -> DataFrame:
    return phones.validate_phones(phone_rows(x), strict=True).select("OrderId", F.col(phones.VALID).alias("valid"))


_BLOCKED = "select Mobile_Number from customer_state where Valid"


@query("q_phone_blocklist", f"""
select OrderId, case when kept in ({_BLOCKED}) then 'xxxxxxxxxx' else kept end mobile_number,
 valid and kept not in ({_BLOCKED}) valid from (select OrderId, {_KEPT} kept, {_VALID} valid from phone_rows) p""")
def phone_blocklist(x: Inputs) -> DataFrame:
    blocked = x.customers.filter("Valid").select("Mobile_Number")
    rows = phones.validate_phones(phone_rows(x), blocklist=blocked)
    return rows.select("OrderId", F.col(phones.CLEAN).alias("mobile_number"), F.col(phones.VALID).alias("valid"))


@query("q_phone_join_form", f"select OrderId, EntryStatus, {_KEPT} mobile_number from phone_rows join raw_orders using (OrderId)")
def phone_join_form(x: Inputs) -> DataFrame:
    checked = phones.validate_phones(phone_rows(x)).select("OrderId", F.col(phones.CLEAN).alias("mobile_number"))
    return x.headers.select("OrderId", "EntryStatus").join(checked, "OrderId", "left")


_UUID = "substr({m},1,8)||'-'||substr({m},9,4)||'-'||substr({m},13,4)||'-'||substr({m},17,4)||'-'||substr({m},21)"


@query("q_customer_id", f"select o_orderkey, {_UUID.format(m='md5(PhoneNo)')} customer_id from raw_orders")
def customer_id(x: Inputs) -> DataFrame:
    return x.headers.select("o_orderkey", stable_id(F.col("PhoneNo")).alias("customer_id"))


def _protected(x: Inputs) -> DataFrame:
    rows = x.headers.select("OrderId", F.col("PhoneNo").alias("Mobile_Number"), "CustomerName", "Email", "City")
    return privacy.protect(rows, ["CustomerName", "Email", "City"], KEY, VECTOR)


def _sealed_length(text: str) -> str:
    """Characters of a sealed text: whole blocks of 16 bytes, one more than full ones, in base64; 0 for a blank."""
    return f"case when coalesce({text}, '') = '' then 0 else 4 * ((16 * (strlen({text}) // 16 + 1) + 2) // 3) end"


@query("q_pii_protect", f"""
select OrderId, {_sealed_length('CustomerName')} name_length, {_sealed_length('Email')} email_length, {_sealed_length('City')} city_length,
 {_sealed_length('PhoneNo')} number_length, true id_is_uuid, false shows_number, false shows_text from raw_orders""")
def pii_protect(x: Inputs) -> DataFrame:
    """What can be said of sealed rows without unsealing them: lengths, the form of the id, and that nothing shows."""
    sealed = _protected(x)
    length = lambda c, name: F.length(c).cast("bigint").alias(name)
    uuid = F.col("Customer_Id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    shows = F.col("City").startswith("City") | F.contains("Email", F.lit("@")) | F.contains("CustomerName", F.lit("Customer"))
    return sealed.select("OrderId", length("CustomerName", "name_length"), length("Email", "email_length"), length("City", "city_length"),
                         length(privacy.ENCRYPTED_MOBILE, "number_length"), uuid.alias("id_is_uuid"),
                         F.lit("Mobile_Number" in sealed.columns).alias("shows_number"), shows.alias("shows_text"))


_SEALED = {"CustomerName": "CustomerName", "Email": "Email", "City": "City", "PhoneNo": privacy.ENCRYPTED_MOBILE, "Customer_Id": "Customer_Id"}


@query("q_pii_equality", " union all ".join(
    f"select '{name}' kind, {'36' if name == 'Customer_Id' else _sealed_length('t')} sealed_length, count(*) row_count "
    f"from (select coalesce({'PhoneNo' if name == 'Customer_Id' else name}, '') t from raw_orders) r group by t" for name in _SEALED))
def pii_equality(x: Inputs) -> DataFrame:
    """Orders per sealed value: equal texts, and only they, are equal when sealed, and so are the ids made of them."""
    values = F.explode(F.array(*[F.struct(F.lit(name).alias("kind"), F.col(c).alias("sealed")) for name, c in _SEALED.items()])).alias("value")
    counted = _protected(x).select(values).groupBy("value.kind", "value.sealed").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select("kind", F.length("sealed").cast("bigint").alias("sealed_length"), "row_count")


@query("q_pii_roundtrip", """
select OrderId, PhoneNo Decrypted_PhoneNo, CustomerName Decrypted_CustomerName, City Decrypted_City,
 CustomerName is null sealed_blank from raw_orders""")
def pii_roundtrip(x: Inputs) -> DataFrame:
    names = ["PhoneNo", "CustomerName", "City"]
    sealed = x.headers.select("OrderId", *[encrypt(F.col(c), KEY, VECTOR).alias(c) for c in names])
    shown = privacy.reveal(sealed, names, KEY, VECTOR).withColumn("sealed_blank", F.col("CustomerName") == "")
    return shown.drop(*names)


@query("q_pii_random_vector", "select OrderId, PhoneNo phone from raw_orders")
def pii_random_vector(x: Inputs) -> DataFrame:
    sealed = x.headers.select("OrderId", encrypt(F.col("PhoneNo"), KEY, None).alias("sealed"))
    return sealed.select("OrderId", decrypt(F.col("sealed"), KEY, None).alias("phone"))


@query("q_already_processed_new", "select Header_Id, OrderId from fresh_orders")
def already_processed_new(x: Inputs) -> DataFrame:
    complete = complete_orders(x, nested_rows=False)
    return state.new_orders(complete, stored_orders(complete)).select("Header_Id", "OrderId")


@query("q_already_processed_seen", "select Header_Id, OrderId from complete_orders where o_orderkey % 10 = 0")
def already_processed_seen(x: Inputs) -> DataFrame:
    complete = complete_orders(x, nested_rows=False)
    return state.seen_orders(complete, stored_orders(complete)).select("Header_Id", "OrderId")


@query("q_id_probe_flags", """
select Header_Id, case when o_orderkey % 10 = 0 then 'yes' else 'no' end available from complete_orders""")
def id_probe_flags(x: Inputs) -> DataFrame:
    complete = complete_orders(x, nested_rows=False)
    return state.availability(complete, stored_orders(complete))


@query("q_register_ids", "select Header_Id from complete_orders")
def register_ids(x: Inputs) -> DataFrame:
    complete = complete_orders(x, nested_rows=False)
    stored = stored_orders(complete)
    return state.register(stored, state.new_orders(complete, stored))


table("customer_delta", f"""
select Header_Id, {K.cleaned_phone('PhoneNo')} mobile, 'N' || OrderId Customer_Id, inv, o_orderkey % 3 = 0 valid,
 o_orderkey % 7 = 0 unsubscribed, case when o_orderkey % 7 = 0 then '2001-01-01' else '' end unsubscribe_date
from complete_orders where PhoneNo is not null""")


def customer_delta(x: Inputs) -> DataFrame:
    rows = complete_orders(x, nested_rows=False).filter(F.col("PhoneNo").isNotNull())
    key = F.col("o_orderkey")
    return rows.select("Header_Id", clean_phone(F.col("PhoneNo")).alias("Encrypted_Mobile_Number"),
                       F.concat(F.lit("N"), "OrderId").alias("Customer_Id"),
                       F.replace("InvoiceDate", F.lit("/"), F.lit("-")).alias("Order_Date"),
                       (key % 3 == 0).alias("Valid"), (key % 7 == 0).alias("Unsubscribed"),
                       F.when(key % 7 == 0, "2001-01-01").otherwise("").alias("Unsubscribe_Date"))


def _merge_sql(valid: str, keep: str) -> str:
    return f"""
select Mobile_Number, Customer_Id, strftime(first_day, '%Y-%m-%d') First_Order_Date, strftime(last_day, '%Y-%m-%d') Last_Order_Date,
 Valid, Unsubscribed, Unsubscribe_Date from (
 select mobile Mobile_Number, min(inv) first_day, max(last_inv) last_day, {valid} Valid,
  arg_max(unsubscribed, (run, last_inv, hid)) Unsubscribed, arg_max(unsubscribe_date, (run, last_inv, hid)) Unsubscribe_Date,
  arg_min(Customer_Id, (run, last_inv, hid)) Customer_Id, max(run) newest
 from (select mobile, inv, inv last_inv, valid, unsubscribed, unsubscribe_date, Customer_Id, 1 run, Header_Id hid from customer_delta
       union all select Mobile_Number, first_day, last_day, Valid, Unsubscribed, Unsubscribe_Date, Customer_Id, 0, '' from customer_state) r
 group by mobile) m where {keep}"""


@query("q_customer_merge", _merge_sql("arg_max(valid, (run, last_inv, hid))", "newest = 1"))
def customer_merge(x: Inputs) -> DataFrame:
    return state.merge_customers(x.customers, customer_delta(x), tie_break=["Header_Id"])


@query("q_customer_snapshot", _merge_sql("bool_or(valid)", "true"))
def customer_snapshot(x: Inputs) -> DataFrame:
    return state.merge_customers(x.customers, customer_delta(x), valid_rule="any", touched_only=False,
                                 tie_break=["Header_Id"])


@query("q_existing_customers", """
select Mobile_Number, Customer_Id from customer_state where Mobile_Number in (select mobile from customer_delta)""")
def existing_customers(x: Inputs) -> DataFrame:
    keys = customer_delta(x).select(F.col("Encrypted_Mobile_Number").alias("Mobile_Number"))
    return state.existing_rows(x.customers, keys, "Mobile_Number").select("Mobile_Number", "Customer_Id")


_MAPPED = ["Store_No", "Receipt_No", "Transaction_No", "Aggregator_Id"]
table("mapping_state", """
select Header_Id, 'OLD' Store_No, OrderId Receipt_No, cast(null as varchar) Transaction_No, 'A' Aggregator_Id
from complete_orders where o_orderkey % 2 = 0""")
table("mapping_delta", """
select Header_Id, StoreCode Store_No, OrderId Receipt_No, TransactionNo Transaction_No,
 case when o_orderkey % 3 = 0 then 'AG' || OrderId else '  ' end Aggregator_Id from complete_orders where o_orderkey % 5 <> 0""")


def mapping_sides(x: Inputs) -> tuple[DataFrame, DataFrame]:
    orders, key = complete_orders(x, nested_rows=False), F.col("o_orderkey")
    old = orders.filter(key % 2 == 0).select("Header_Id", F.lit("OLD").alias("Store_No"),
                                             F.col("OrderId").alias("Receipt_No"),
                                             F.lit(None).cast("string").alias("Transaction_No"),
                                             F.lit("A").alias("Aggregator_Id"))
    agg = codes.blank_to(F.when(key % 3 == 0, F.concat(F.lit("AG"), "OrderId")), "  ")
    new = orders.filter(key % 5 != 0).select("Header_Id", F.col("StoreCode").alias("Store_No"),
                                             F.col("OrderId").alias("Receipt_No"),
                                             F.col("TransactionNo").alias("Transaction_No"), agg.alias("Aggregator_Id"))
    return old, new


@query("q_mapping_merge", """
select Header_Id, coalesce(Store_No, '') Store_No, coalesce(Receipt_No, '') Receipt_No, coalesce(Transaction_No, '') Transaction_No,
 coalesce(Aggregator_Id, '') Aggregator_Id from (
 select * from mapping_delta union all select * from mapping_state where Header_Id not in (select Header_Id from mapping_delta)) m""")
def mapping_merge(x: Inputs) -> DataFrame:
    return state.merge_mapping(*mapping_sides(x))


@query("q_keyed_put", """
select Header_Id, Store_No, Receipt_No from (select * from mapping_delta union all
 select * from mapping_state where Header_Id not in (select Header_Id from mapping_delta)) m""")
def keyed_put(x: Inputs) -> DataFrame:
    old, new = mapping_sides(x)
    first, second = new_folder(x.spark, "mapping"), new_folder(x.spark, "mapping")
    write_snapshot(old, first)
    stored = x.spark.read.schema(old.schema).parquet(first)
    write_snapshot(state.replace_rows(stored, new, "Header_Id"), second)
    return x.spark.read.schema(old.schema).parquet(second).select("Header_Id", "Store_No", "Receipt_No")


@query("q_state_merge_union", "select * from mapping_delta")
def state_merge_union(x: Inputs) -> DataFrame:
    old, new = mapping_sides(x)
    return state.replace_rows(old, new, "Header_Id", touched_only=True)


@query("q_existing_mapping", "select * from mapping_state where Header_Id in (select Header_Id from mapping_delta)")
def existing_mapping(x: Inputs) -> DataFrame:
    old, new = mapping_sides(x)
    return state.existing_rows(old, new, "Header_Id")


@query("q_pii_upsert", """
select Header_Id, coalesce(Email, '') Email, coalesce(Customer_Name, '') Customer_Name, Valid from (
 select Header_Id, Email, CustomerName Customer_Name, true Valid from complete_orders where o_orderkey % 5 <> 0
 union all select Header_Id, 'old', 'old', false from complete_orders where o_orderkey % 10 = 0) p""")
def pii_upsert(x: Inputs) -> DataFrame:
    orders, key = complete_orders(x, nested_rows=False), F.col("o_orderkey")
    old = orders.filter(key % 2 == 0).select("Header_Id", F.lit("old").alias("Email"), F.lit("old").alias("Customer_Name"),
                                             F.lit(False).alias("Valid"))
    new = orders.filter(key % 5 != 0).select("Header_Id", "Email", F.col("CustomerName").alias("Customer_Name"),
                                             F.lit(True).alias("Valid"))
    return state.merge_order_pii(old, dedupe.dedupe_by(new, ["Header_Id"]))


@query("q_stored_rows_anti", "select Header_Id, Store_No from mapping_delta where Header_Id not in (select Header_Id from mapping_state)")
def stored_rows_anti(x: Inputs) -> DataFrame:
    old, new = mapping_sides(x)
    return dedupe.without_keys(new, old, ["Header_Id"]).select("Header_Id", "Store_No")
