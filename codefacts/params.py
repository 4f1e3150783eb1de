"""Parameter tables.

The operators take these as arguments (usually as small DataFrames built by
``as_df``), so a user extends them by passing their own values. The defaults
below are fixed values: they must equal the analysed tool's lists for equal
results, and are stated plainly, in their original order.
"""

from __future__ import annotations


# ----------------------------------------------------------------------------
# Fixed values (backend call classification, SURVEY G5-G7)
# ----------------------------------------------------------------------------
ROUTER_PATTERNS = [
    "rest.Post", "rest.Get", "rest.Put", "rest.Delete", "rest.Patch",
    "rest.Options", "rest.Head",
    "HandleFunc",
    ".GET(", ".POST(", ".PUT(", ".DELETE(", ".PATCH(", ".OPTIONS(",
]
DB_PATTERNS = ["db.", ".Query", ".QueryRow", ".Exec", ".Prepare", "tx."]
HTTP_CLIENT_PATTERNS = ["http.NewRequest", "http.Get(", "http.Post(", "http.Client",
                        "client.Do", ".Do(req"]
ERROR_CONSTRUCTORS = ["errors.New", "fmt.Errorf", "errors.Errorf"]

# ----------------------------------------------------------------------------
# Fixed values (schema expansion, SURVEY E5-E7, E15)
# ----------------------------------------------------------------------------
PRIMITIVE_TYPES = [
    "string", "bool", "int", "int8", "int16", "int32", "int64",
    "uint", "uint8", "uint16", "uint32", "uint64",
    "float32", "float64", "byte", "rune", "[]byte",
]
# name -> (json type, description)
SCALAR_ALIASES = [
    ("sessionID", "string", "세션 ID (64자 hex)"),
    ("Permission", "string", "사용자 권한 타입 (Admin|Employee|Professor|Student)"),
    ("TermStatus", "string", "학기 상태 (READY|APPLYING|PROCEEDING|GRADUATED)"),
    ("Semester", "string", "학기 구분 (SPRING|FALL)"),
    ("Grade", "string", "학년 등급"),
    ("Status", "string", "상태 값"),
    ("RegistrationStatus", "string", "수강 신청 상태 (REQUESTED|ENROLLED|CANCELED 등)"),
]
SESSION_ID_TYPE = "sessionID"
SESSION_ID_DESCRIPTION = "세션 ID"
TYPE_NAME_ALIASES = [("term", "Term")]
# handler -> request struct (None: the handler has no request struct)
HANDLER_PARAM_OVERRIDES = [
    ("addSpringRegistration", "addRegistrationParam"),
    ("updateLectureAttachment", "updateLectureAttachParam"),
    ("updateBoardAttachment", "updateBoardAttachParam"),
    ("HandleRequest", None),
]
MAX_SCHEMA_DEPTH = 4

# ----------------------------------------------------------------------------
# Fixed values (client, SURVEY H1, H3, H11, H19, H21, H26, H28-H30)
# ----------------------------------------------------------------------------
PERM_BITS = [(1, "Admin"), (2, "Employee"), (4, "Professor"), (8, "Student")]
TRANSLATOR_FUNC_TO_DOMAIN = [
    ("termStatusKR", "TermStatus"),
    ("semesterKR", "Semester"),
    ("gradeKR", "Grade"),
    ("gradeENG", "GradeEnglish"),
    ("gradeStatusKR", "StudentStatus"),
    ("statusKR", "RequestStatus"),
    ("categoryKR", "LectureCategory"),
    ("categoryENG", "LectureCategoryEnglish"),
]
API_METHOD_SKIP = ["constructor", "class", "if", "for", "while", "switch"]
THIS_CALL_SKIP = ["$store", "$router", "$swal", "$error", "$emit", "$refs",
                  "$moment", "$base64Decode", "$asciiDecode", "$categoryKR",
                  "$semesterKR", "$termStatusKR", "go", "push", "replace",
                  "showLoading", "close"]
LIFECYCLE_HOOKS = ["created", "mounted"]
SUCCESS_WORDS = ["완료", "성공", "추가되었", "수정되었", "삭제되었", "저장되었"]
ERROR_WORDS = ["오류", "실패", "없습니다", "에러"]
DISABLED_GUARD_WORDS = ["FINISHED", "status", "enabled", "isAdmin", "role", "Admin"]
VFOR_FIELD_SKIP = ["length", "toString", "valueOf", "constructor", "key", "index"]
STORE_ACTION_SKIP = ["login", "logout", "state", "commit", "dispatch", "getters",
                     "rootState", "rootGetters", "if", "for", "while"]
STORE_GETTER_SKIP = ["state", "getters", "if", "for"]
STORE_STATE_SKIP = ["isLogin", "sessionID", "user"]
# client-only requirement templates: guard flag -> (description, actor)
GUARD_TEMPLATES = [
    ("needs_graduated", "졸업 상태인 학생만 해당 페이지에 접근할 수 있다", "graduated_student"),
    ("needs_not_graduated", "재학/수료/제적 상태인 학생만 해당 페이지에 접근할 수 있다",
     "enrolled_student"),
]
ROUTER_SOURCE = "router/index.js"
STORE_SOURCE = "store/index.js"
