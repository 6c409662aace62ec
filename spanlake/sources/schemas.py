"""Schemas of the two input tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Columns and types of the snapshot table, in file order.
SNAPSHOT_DDL = """
ID BIGINT, NLD_ID BIGINT, SO_SO_BHXH STRING, THANG_BD STRING, THANG_KT STRING,
TT_TG_BHXH STRING, DT_TG_BHXH STRING, NAM_TG_BHXH INT, THANG_TG_BHXH INT,
NAM_TG_BHXH_BB INT, THANG_TG_BHXH_BB INT, TT_TG_BHTN STRING, DT_TG_BHTN STRING,
NAM_TG_BHTN INT, THANG_TG_BHTN INT, TT_TG_BHYT STRING, DT_TG_BHYT STRING,
NAM_TG_BHYT INT, THANG_TG_BHYT INT, NAM_NO_BHXH INT, THANG_NO_BHXH INT,
NAM_NO_BHTN INT, THANG_NO_BHTN INT, TT_TG_BH STRING, DT_TG_BH STRING,
TU_THANG_DVI STRING, DEN_THANG_DVI STRING, DEN_THANG_HTTT STRING, DEN_THANG_BHTN STRING,
THANG_BD_LT STRING, THANG_KT_LT STRING, SO_THANG_LT INT, IS_ERRORS INT, NGHI_VIEC INT,
IS_CONTINUE INT, TRUY_DONG INT, DEN_NGAY STRING, MA_CD STRING, MA_NHH STRING,
DD_MA_DON_VI STRING, DD_THANG_DONG_DEN_XH STRING, DD_TY_LE_NO_BHXH DOUBLE,
DD_THANG_DONG_DEN_YT STRING, DD_TY_LE_NO_BHYT DOUBLE, DD_THANG_DONG_DEN_TN STRING,
DD_TY_LE_NO_BHTN DOUBLE, DD_THANG_DONG_DEN_TNLD STRING, DD_TY_LE_NO_TNLD DOUBLE,
RAW_RESPONSE STRING, CREATED_AT STRING
"""

# Columns and types of the period table, in file order.
PERIOD_DDL = """
ID BIGINT, MASTER_ID BIGINT, NLD_ID BIGINT, DOT_PHAT_SINH STRING, TU_THANG STRING,
DEN_THANG STRING, MA_DON_VI STRING, TEN_DON_VI STRING, LOAI_DT STRING, LOAI INT,
PA STRING, DON_VI_TINH STRING, MA_NT STRING, CHUC_DANH_CV STRING, CHUC_DANH_CV_PRE STRING,
NOI_LAM_VIEC STRING, NOI_DUNG STRING, MUC_LUONG DOUBLE, MUC_LUONG_TN DOUBLE,
MUC_LUONG_BHYT DOUBLE, MUC_LUONG_PC DOUBLE, MUC_LUONG_BS DOUBLE, MUC_LUONG_NLD DOUBLE,
MUC_LUONG_NSNN DOUBLE, MUC_LUONG_HS DOUBLE, MUC_LUONG_TT DOUBLE, HS_LUONG DOUBLE,
PC_CHUC_VU DOUBLE, PC_THAM_NIEN DOUBLE, PC_NGHE DOUBLE, PC_KHU_VUC DOUBLE, PC_KHAC DOUBLE,
PC_TAI_CU DOUBLE, HS_TN DOUBLE, HS_NG DOUBLE, HS_TC DOUBLE, TYLE_BHXH DOUBLE,
TYLE_BHYT DOUBLE, TYLE_BHTN DOUBLE, TYLE_TUDV DOUBLE, TYLE_HTTT DOUBLE, TYLE_ODTS DOUBLE,
TYLE_TNLD DOUBLE, TYLE_NSNN DOUBLE, DK1 INT, DK2 INT, DK3 INT, DK4 INT, DK5 INT, DK6 INT,
IS_BHXH INT, IS_BHXH_BB INT, IS_BHTN INT, IS_BHYT INT, IS_BHXH2 INT, IS_BHTN2 INT,
IS_ERROR INT, IS_TR INT, IS_BONUS INT, ML_TC INT, GHI_CHU STRING, KIEM_TRA INT,
SO_THANG INT, MA_KHOI_TK STRING, TY_LE_DONG DOUBLE, MUC_DONG DOUBLE, LUONG_CHINH DOUBLE,
CHUC_DANH_NLV STRING, PHUONG_THUC STRING, PHUONG_THUC_DONG STRING, MUC_LUONG_PRE DOUBLE,
MUC_LUONG_PC_PRE DOUBLE, MUC_LUONG_BS_PRE DOUBLE, HS_LUONG_PRE DOUBLE,
PC_CHUC_VU_PRE DOUBLE, PC_THAM_NIEN_PRE DOUBLE, PC_NGHE_PRE DOUBLE, PC_KHU_VUC_PRE DOUBLE,
PC_KHAC_PRE DOUBLE, PC_TAI_CU_PRE DOUBLE, LUONG_CHINH_PRE DOUBLE, CREATED_AT STRING
"""


def snapshot_schema() -> StructType:
    return StructType.fromDDL(SNAPSHOT_DDL)


def period_schema() -> StructType:
    return StructType.fromDDL(PERIOD_DDL)
