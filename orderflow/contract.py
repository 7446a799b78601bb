"""Column contracts shared by the sources, operators and daily plan.

Everything in this module is a fixed value: the names below are what the input
files carry and what readers of the output tables expect, so they are stated
as they are and not derived.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: str) -> list[T.StructField]:
    return [T.StructField(n.strip(), T.StringType()) for n in names.split(",")]


# The nested point-of-sale order record -------------------------

ORDER_ROW_TAG = "CustomerInformation"

ITEM_FIELDS = T.StructType(_strings(
    "CGST, CouponNo, DiscountAmount, FoodType, ItemCatagory, ItemName, ItemNo, LineDiscount, NetAmount, "
    "ProductGroup, PromoName, Promono, Quantity, SGST, SizeCode, StandardAmount, TotalDiscount, "
    "TotalRoundedAmount"))

PAYMENT_FIELDS = T.StructType(_strings("Amount, Date, Mode, TenderType"))

RAW_ORDER_SCHEMA = T.StructType(
    _strings("BillCloseddate, BillClosetime, CGST, City, Counter, CouponNo, CustomerName, Email, EntryStatus, "
             "InvoiceDate, InvoiceNo, InvoiceTime")
    + [T.StructField("ItemDetails", T.StructType([T.StructField("Items", T.ArrayType(ITEM_FIELDS))]))]
    + _strings("NetAmount, OrderId, OrderSource, OrderType, OriginatedFromStore")
    + [T.StructField("PaymentsDetails", T.StructType([T.StructField("Payments", T.ArrayType(PAYMENT_FIELDS))]))]
    + _strings("PhoneNo, PosTerminalNo, ReteriveFromReceiptNo, SGST, SaleIsReturn, StoreCode, StoreName, "
               "TotalOrderValue, Totaldiscount, Totalorderqty, TransactionNo, WeborderNo"))

MANDATORY_ORDER_COLUMNS = ["OrderId", "TransactionNo", "StoreCode", "InvoiceDate", "Totalorderqty",
                           "TotalOrderValue", "NetAmount", "SGST", "CGST"]
MANDATORY_ITEM_COLUMNS = ["OrderId", "TransactionNo", "StoreCode", "ItemNo", "Quantity", "NetAmount",
                          "TotalRoundedAmount"]
MANDATORY_PAYMENT_COLUMNS = ["OrderId", "TransactionNo", "StoreCode", "PosTerminalNo", "TenderType", "Amount"]

# The aggregator feed -------------------------------------------

FEED_SCHEMA = T.StructType(_strings(
    "Latitude, Store Code, Longitude, OrderNo, marketing Communication, Order_Date, Order Time, Pasta by PH, "
    "Discount Voucher Code, Discount Amount, discount_code, Discount_type_ID, Discount_type_type, "
    "Discount_appexclusive, Discount_value, Aggregator Order ID, MobileNo, Email, Order Status, Order Type, "
    "New_Channel, Reference No, Gift Card, Gift card amount, Gift card No, utm_source, utm_medium, "
    "utm_campaign, Franchise"))
FEED_DATE = "feed_date"
FEED_EMAIL = "PHDV_Email"
FEED_WINDOW_DAYS = 2
FRANCHISE = "dil"
DEFAULT_FRANCHISE = "DIL"
BRAND_PREFIXES = {"PH": "PizzaHut", "Pasta": "PastaByPizzaHut"}

# Lookups ---------------------------------------------------------

CHANNEL_LOOKUP_SCHEMA = T.StructType(_strings("Sales_Channel_Map, Order_Type_Map, Channel_Id"))
CHANNEL_DIMENSION_SCHEMA = T.StructType(_strings("Mapping_Channel_Id, Source, Channel, Fulfilment_Mode"))
ORDER_COMBINATION_SCHEMA = T.StructType(_strings("OrderSource_map, OrderType_map, Combination_Id"))
CHANNEL_COMBINATION_SCHEMA = T.StructType(
    _strings("Combination_Id, Enriched_Order_Type, Enriched_Channel, Fulfilment_Mode"))

STORE_KEY = "updated_code"
STORE_COLUMNS = ["FZE", "Champs", "City", "State", "Zone", "Cluster", "Format", "Location", "Tier", "Region",
                 "updated_code"]
STORE_RENAMES = {
    "FZE": "StoreMaster_Franchise", "Champs": "StoreMaster_Champ_Id", "City": "StoreMaster_Store_City",
    "State": "StoreMaster_State", "Cluster": "StoreMaster_Cluster", "Format": "StoreMaster_Format",
    "Location": "StoreMaster_Location", "Tier": "StoreMaster_Tier_Category", "Region": "StoreMaster_Region",
    "S_Name": "StoreMaster_StoreName", "Zone": "StoreMaster_Zone",
}

# Order (baseline) output -------------------------------------------

HEADER_RENAMES = {
    "OrderId": "Receipt_No", "TransactionNo": "Transaction_No", "InvoiceNo": "Invoice_No",
    "WeborderNo": "WebOrderNo", "StoreCode": "Store_No", "City": "Store_City", "StoreName": "Store_Name",
    "OrderSource": "Sales_Channel", "OrderType": "Order_Type", "PosTerminalNo": "POS_Terminal_No",
    "SaleIsReturn": "Sale_Is_Return_Sale", "ReteriveFromReceiptNo": "Retrieved_Receipt_No",
    "InvoiceDate": "Invoice_Open_Date", "InvoiceTime": "Invoice_Open_Time",
    "BillCloseddate": "Invoice_Closed_Date", "BillClosetime": "Invoice_closed_Time",
    "CustomerName": "Customer_Name", "Email": "Email", "Totalorderqty": "Order_Quantity",
    "TotalOrderValue": "Gross_Amount", "NetAmount": "Net_Amount", "SGST": "SGST", "CGST": "CGST",
    "Totaldiscount": "Discount_Amount", "CouponNo": "Coupon_Code", "Counter": "Counter_ID",
    "EntryStatus": "Entry_Status", "OriginatedFromStore": "Originated_From_Store",
    "Latitude": "PHDV_Latitude", "Longitude": "PHDV_Longitude",
    "marketing Communication": "PHDV_Marketing_Communication",
    "Discount Voucher Code": "PHDV_Discount_Voucher_Code", "discount_code": "PHDV_Discount_Code",
    "Discount_type_ID": "PHDV_Discount_Type_Id", "Discount_type_type": "PHDV_Discount_Type",
    "Discount_appexclusive": "PHDV_Discount_App_Exclusive", "Discount_value": "PHDV_Discount_Value",
    "Aggregator Order ID": "PHDV_Aggregator_Id", "Order Status": "PHDV_Order_Status",
    "Order Type": "PHDV_OrderType", "New_Channel": "PHDV_Channel", "Reference No": "PHDV_Reference_No",
    "Gift Card": "PHDV_GiftCard", "Gift card amount": "PHDV_GiftCard_Amount",
    "Gift card No": "PHDV_GiftCard_No", "Order Time": "PHDV_Order_Time", "utm_source": "PHDV_Utm_Source",
    "utm_medium": "PHDV_Utm_Medium", "utm_campaign": "PHDV_Utm_Campaign",
    "Discount Amount": "PHDV_Discount_Amount", "CleanedPhoneNumber": "Mobile_Number",
    "Enriched_WebOrder_No": "Enriched_WebOrderNo", "Pizzahut_Brand": "PHDV_Pizzahut_Brand",
}

BASELINE_COLUMNS = [
    "Header_Id", "Franchise", "Receipt_No", "Store_No", "Invoice_Open_Date", "Enriched_Order_Date",
    "Invoice_Open_Time", "Enriched_Order_Time", "Sales_Channel", "Order_Type", "Enriched_Sales_Channel",
    "Enriched_Order_Type", "Channel_Id", "Source", "Channel", "Fulfilment_Mode", "Order_Quantity", "Net_Amount",
    "Gross_Amount", "Tax_Amount", "SGST", "CGST", "Discount_Amount", "Coupon_Code", "Payment_Mode", "Gift_Card",
    "Gift_Card_Amount", "Deal", "Ala_Carte", "Non_Veg", "Year", "Month", "Week_Day", "Week_Number",
    "Hour_Day_Part", "Day_Part", "WebOrderNo", "Enriched_WebOrderNo", "PHDV_Reference_No", "PHDV_OrderType",
    "PHDV_Channel", "PHDV_Pizzahut_Brand", "PHDV_Latitude", "PHDV_Longitude", "PHDV_Marketing_Communication",
    "PHDV_Discount_Voucher_Code", "PHDV_Discount_Amount", "PHDV_Discount_Code", "PHDV_Discount_Type_Id",
    "PHDV_Discount_Type", "PHDV_Discount_App_Exclusive", "PHDV_Discount_Value", "PHDV_Aggregator_Id",
    "PHDV_Order_Status", "PHDV_GiftCard", "PHDV_Order_Time", "PHDV_GiftCard_Amount", "PHDV_GiftCard_No",
    "PHDV_Utm_Source", "PHDV_Utm_Medium", "PHDV_Utm_Campaign", "Orderwise_Id", "Transaction_No", "Invoice_No",
    "POS_Terminal_No", "Sale_Is_Return_Sale", "Retrieved_Receipt_No", "Business_Date", "Invoice_Closed_Date",
    "Invoice_closed_Time", "Counter_ID", "Originated_From_Store", "Store_Name", "Store_City",
    "StoreMaster_Franchise", "StoreMaster_Champ_Id", "StoreMaster_Store_City", "StoreMaster_State",
    "StoreMaster_Cluster", "StoreMaster_Format", "StoreMaster_Location", "StoreMaster_Tier_Category",
    "StoreMaster_Region", "StoreMaster_Zone", "System_Processed_Date", "Entry_Status", "Valid_Transaction",
]
BASELINE_PLACEHOLDERS = ["GES_Code", "Transaction_Type"]
BASELINE_DATE_COLUMNS = ["Invoice_Open_Date", "Invoice_Closed_Date", "Business_Date", "System_Processed_Date",
                         "Enriched_Order_Date"]

# Line (item) output --------------------------------------------------

LINE_HEADER_COLUMNS = ["Header_Id", "OrderId", "TransactionNo", "StoreCode", "Day_Part", "Store_Franchise",
                       "StoreName", "Counter", "PosTerminalNo", "Enriched_Order_Date", "Enriched_Order_Time",
                       "Valid_Transaction"]
LINE_RENAMES = {
    "OrderId": "Receipt_No", "TransactionNo": "Transaction_No", "StoreCode": "Store_No",
    "StoreName": "Store_Name", "PosTerminalNo": "POS_Terminal_No", "Enriched_Order_Date": "Invoice_Open_Date",
    "Enriched_Order_Time": "Invoice_Open_Time", "ItemNo": "Item_No", "ItemName": "Item_Name",
    "Promono": "Deal_ID", "PromoName": "Deal_Name", "LineDiscount": "Line_Discount", "Quantity": "Quantity",
    "DiscountAmount": "Discount_Amount", "NetAmount": "Line_Net_Amount", "CouponNo": "Discount_code",
    "ItemCatagory": "Item_Category", "ProductGroup": "Item_Range", "TotalRoundedAmount": "Gross",
    "SizeCode": "Size_ID", "Counter": "Counter_ID", "StandardAmount": "Ala_Carte_Price",
    "TotalDiscount": "Total_Discount", "FoodType": "Food_Type", "Store_Franchise": "Franchise",
}
LINE_COLUMNS = [
    "Line_Id", "Line_No", "Header_Id", "Receipt_No", "Transaction_No", "Store_No", "Store_Name", "Counter_ID",
    "Total_Discount", "POS_Terminal_No", "Invoice_Open_Date", "Invoice_Open_Time", "Item_No", "Item_Name",
    "Deal_ID", "Deal_Name", "Line_Discount", "Quantity", "Discount_Amount", "Line_Net_Amount", "Discount_code",
    "Item_Category", "Item_Range", "Gross", "Size_ID", "Ala_Carte_price", "Food_Type", "Base", "Parent_ID",
    "Tax_Amount", "Franchise", "Day_Part",
]
LINE_AMOUNT_COLUMNS = ["SGST", "CGST", "DiscountAmount", "StandardAmount", "TotalDiscount", "LineDiscount",
                       "TotalRoundedAmount", "NetAmount"]
LINE_PLACEHOLDERS = ["Deal_Identifier"]
LINE_DATE_COLUMNS = ["Invoice_Open_Date"]

# Payment output ---------------------------------------------------------

PAYMENT_HEADER_COLUMNS = ["Header_Id", "OrderId", "TransactionNo", "StoreCode", "StoreName", "BillClosetime",
                          "PosTerminalNo", "Totalorderqty", "Enriched_Order_Date", "Enriched_Order_Time"]
PAYMENT_RENAMES = {
    "OrderId": "Receipt_No", "TransactionNo": "Transaction_No", "StoreCode": "Store_No",
    "StoreName": "Store_Name", "PosTerminalNo": "POS_Terminal_No", "Enriched_Order_Date": "Invoice_Open_Date",
    "Enriched_Order_Time": "Invoice_Open_Time", "BillClosetime": "Tender_Time", "Payment_Date": "Tender_Date",
    "Payment_TenderType": "Tender_No", "Payment_Mode": "Tender_Name", "Payment_Amount": "Gross",
}
PAYMENT_COLUMNS = ["Payment_Id", "Line_No", "Header_Id", "Receipt_No", "Transaction_No", "Store_No",
                   "Store_Name", "POS_Terminal_No", "Invoice_Open_Date", "Invoice_Open_Time", "Tender_date",
                   "Tender_time", "Tender_No", "Tender_Name", "Gross"]
PAYMENT_PLACEHOLDERS = ["Tender_Reference"]
PAYMENT_DATE_COLUMNS = ["Invoice_Open_Date", "Tender_date"]
GIFT_CARD_MODE = "Gift Card"

# Personal data and state tables ---------------------------------------------

PII_HEADER_COLUMNS = ["Mobile_Number", "Valid", "Header_Id", "Customer_Name", "Enriched_Email_Id",
                      "Enriched_Order_Date", "Enriched_Order_Time", "Store_No", "Receipt_No", "PHDV_Latitude",
                      "PHDV_Longitude", "Store_City", "Franchise"]
PII_RENAMES = {"Enriched_Email_Id": "Email", "Enriched_Order_Date": "Order_Date",
               "Enriched_Order_Time": "Order_Time", "Store_No": "Store_Code", "Receipt_No": "Order_Id",
               "Store_City": "City", "PHDV_Latitude": "Latitude", "PHDV_Longitude": "Longitude"}
PII_ENCRYPTED_COLUMNS = ["Customer_Name", "Email", "Address", "Latitude", "Longitude", "City"]
PII_COLUMNS = ["Mobile_Number", "Valid", "Customer_Name", "Customer_Id", "Email", "Order_Date", "Address",
               "Store_Code", "Order_Id", "Latitude", "Longitude", "City", "Order_Time", "Header_Id",
               "Franchise", "Unsubscribed", "Unsubscribe_Date"]
PII_STATE_RENAMES = {"Order_Date": "Enriched_Order_Date", "Address": "Customer_Address",
                     "Store_Code": "Store_No", "Order_Id": "Receipt_No", "Order_Time": "Enriched_Order_Time"}
CUSTOMER_DELTA_COLUMNS = ["Customer_Id", "Encrypted_Mobile_Number", "Valid", "Order_Date", "Unsubscribed",
                          "Unsubscribe_Date"]
CUSTOMER_STATE_SCHEMA = T.StructType(
    _strings("Mobile_Number, Customer_Id, First_Order_Date, Last_Order_Date")
    + [T.StructField("Valid", T.BooleanType()), T.StructField("Unsubscribed", T.BooleanType()),
       T.StructField("Unsubscribe_Date", T.StringType())])

MAPPING_HEADER_COLUMNS = ["Header_Id", "Store_No", "Channel", "Source", "Fulfilment_Mode", "PHDV_Aggregator_Id",
                          "PHDV_Reference_No", "Enriched_WebOrderNo", "Receipt_No", "Transaction_No",
                          "Invoice_No", "Enriched_Order_Date", "Enriched_Order_Time", "Franchise",
                          "PHDV_Pizzahut_Brand", "Mobile_Number"]
MAPPING_RENAMES = {"PHDV_Aggregator_Id": "Aggregator_Id", "Fulfilment_Mode": "Fullfillment",
                   "Enriched_WebOrderNo": "Online_ref_ID", "PHDV_Reference_No": "Reference_No",
                   "PHDV_Pizzahut_Brand": "Pizzahut_Brand"}
MAPPING_STATE_SCHEMA = T.StructType(_strings(
    "Header_Id, Customer_Id, Aggregator_Id, Store_No, Channel, Source, Fullfillment, Online_ref_ID, "
    "Reference_No, Receipt_No, Transaction_No, Invoice_No, Enriched_Order_Date, Enriched_Order_Time, "
    "Franchise, Pizzahut_Brand"))
MISSING_PHONE = "xxxxxxxxxx"
