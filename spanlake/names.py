"""Column names, texts and formats that are part of the data contract."""

# Columns of the two input tables that the operators read.
ID = "ID"
WORKER = "NLD_ID"
PERSON = "SO_SO_BHXH"
CREATED = "CREATED_AT"
MASTER_ID = "MASTER_ID"
START = "TU_THANG"
END = "DEN_THANG"
EMPLOYER = "MA_DON_VI"
SALARY = "MUC_LUONG"

# Columns of the derived tables.
SOURCE_FILE = "source_file"
LOAD_TIME = "load_time"
LAYER = "layer"
IS_DELETED = "IS_DELETED"
DELETED_AT = "DELETED_AT"
REJECT_REASON = "REJECT_REASON"
MONTH = "THANG_ID"
PEOPLE = "SO_NGUOI_THAM_GIA"
EMPLOYERS = "SO_DON_VI"
PAYROLL = "TONG_QUY_LUONG"
MEAN_PAY = "LUONG_BINH_QUAN"
ZERO_PAY_PEOPLE = "SO_NGUOI_LUONG_0"

# Columns of the report's summary.
PEAK_PEOPLE = "MAX_NGUOI_THAM_GIA"
PAYROLL_OF_ALL_MONTHS = "SUM_QUY_LUONG_TAT_CA_THANG"
ZERO_PAY_HEAD_MONTHS = "SUM_NGUOI_LUONG_0"

# Headings of the presented report, in the order of the report's columns.
REPORT_HEADINGS = {
    MONTH: "Tháng",
    PEOPLE: "Số người tham gia",
    EMPLOYERS: "Số đơn vị",
    PAYROLL: "Tổng quỹ lương (đ)",
    MEAN_PAY: "Lương bình quân (đ)",
    ZERO_PAY_PEOPLE: "Số người lương 0",
}

# Fixed value: time zone in which the jobs render their load time.
TIME_ZONE = "Asia/Ho_Chi_Minh"
