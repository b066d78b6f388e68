"""Phrases and marks of the supported languages that decide what the quality rules reject.

Fixed values: results depend on them byte for byte, so they must not be normalised or re-ordered.
"""

from __future__ import annotations

#: Policy phrases looked for in every language; fixed values.
ENGLISH_POLICY = [
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "use of cookies",
    "use cookies",
    "accept cookies",
    "cookie settings",
    "gdpr",
    "all rights reserved",
    "copyright ©",
    "subscribe to our newsletter",
    "sign up for our newsletter",
]

#: Placeholder texts looked for in every language; fixed values.
COMMON_PLACEHOLDERS = [
    "lorem ipsum",
    "dolor sit amet",
    "consectetur adipiscing",
]

#: Phrases of policies, log-ins and site furniture; fixed values.
POLICY = {
    "ar": [
        "سياسة الخصوصية",
        "شروط الاستخدام",
        "شروط الخدمة",
        "سياسة ملفات تعريف الارتباط",
        "ملفات تعريف الارتباط",
        "نستخدم ملفات تعريف الارتباط",
        "جميع الحقوق محفوظة",
        "حقوق الطبع والنشر",
        "حقوق النشر محفوظة",
        "اشترك في النشرة الإخبارية",
        "سجل في النشرة",
        "للاشتراك في القائمة البريدية",
        "أدخل بريدك الإلكتروني",
        "تسجيل الدخول",
        "إنشاء حساب",
        "هل نسيت كلمة المرور",
        "تابعنا على",
        "شاركنا على",
        "اقرأ المزيد",
        "المزيد من المقالات",
        "مقالات ذات صلة",
        "التعليقات مغلقة",
        "اترك تعليقا",
    ],
    "tr": [
        "gizlilik politikası",
        "gizlilik sözleşmesi",
        "kullanım şartları",
        "kullanım koşulları",
        "hizmet şartları",
        "çerez politikası",
        "çerezleri kullanıyoruz",
        "çerez kullanımı",
        "tüm hakları saklıdır",
        "telif hakkı",
        "bültene abone ol",
        "e-bülten",
        "e-posta adresinizi girin",
        "giriş yap",
        "oturum aç",
        "hesap oluştur",
        "kayıt ol",
        "şifremi unuttum",
        "bizi takip edin",
        "sosyal medya",
        "ilgili yazılar",
        "ilgili haberler",
        "devamını oku",
        "daha fazla",
        "yorum yap",
        "yorumlar kapalı",
    ],
    "hi": [
        "गोपनीयता नीति",
        "निजता नीति",
        "सेवा की शर्तें",
        "उपयोग की शर्तें",
        "नियम और शर्तें",
        "कुकी नीति",
        "कुकीज़ का उपयोग",
        "सभी अधिकार सुरक्षित",
        "कॉपीराइट",
        "न्यूज़लेटर",
        "न्यूज़लेटर सदस्यता",
        "ईमेल दर्ज करें",
        "अपना ईमेल दर्ज करें",
        "लॉगिन करें",
        "साइन इन",
        "खाता बनाएं",
        "रजिस्टर करें",
        "पासवर्ड भूल गए",
        "हमें फॉलो करें",
        "सोशल मीडिया",
        "संबंधित लेख",
        "संबंधित समाचार",
        "और पढ़ें",
        "अधिक जानें",
        "टिप्पणी करें",
        "टिप्पणियाँ बंद",
    ],
    "it": [
        "informativa sulla privacy",
        "politica sulla privacy",
        "termini di servizio",
        "termini di utilizzo",
        "condizioni d'uso",
        "termini e condizioni",
        "politica dei cookie",
        "utilizziamo i cookie",
        "questo sito utilizza cookie",
        "tutti i diritti riservati",
        "diritti riservati",
        "copyright",
        "iscriviti alla newsletter",
        "newsletter",
        "inserisci la tua email",
        "inserisci il tuo indirizzo",
        "accedi",
        "accesso",
        "crea un account",
        "registrati",
        "password dimenticata",
        "seguici su",
        "social media",
        "articoli correlati",
        "potrebbe interessarti",
        "leggi tutto",
        "continua a leggere",
        "lascia un commento",
        "commenti chiusi",
        "aggiungi al carrello",
        "acquista ora",
    ],
    "th": [
        "นโยบายความเป็นส่วนตัว",
        "นโยบายคุ้มครองข้อมูลส่วนบุคคล",
        "ข้อกำหนดการใช้งาน",
        "ข้อกำหนดและเงื่อนไข",
        "เงื่อนไขการใช้บริการ",
        "นโยบายคุกกี้",
        "เว็บไซต์นี้ใช้คุกกี้",
        "สงวนลิขสิทธิ์",
        "ลิขสิทธิ์",
        "สมัครรับข่าวสาร",
        "กรอกอีเมล",
        "เข้าสู่ระบบ",
        "ลงทะเบียน",
        "สมัครสมาชิก",
        "ลืมรหัสผ่าน",
        "ติดตามเรา",
        "แชร์บน",
        "อ่านเพิ่มเติม",
        "บทความที่เกี่ยวข้อง",
        "แสดงความคิดเห็น",
        "ปิดความคิดเห็น",
    ],
}

#: Placeholder texts; fixed values.
PLACEHOLDERS = {
    "ar": ["هذا النص هو مثال", "نص تجريبي", "هذا نص وهمي"],
    "tr": ["bu bir örnek metindir", "deneme metni", "örnek metin"],
    "hi": ["यह एक उदाहरण है", "परीक्षण पाठ", "नमूना पाठ", "डमी टेक्स्ट"],
    "it": ["questo è un esempio", "testo di prova", "testo di esempio", "lorem ipsum"],
    "th": ["นี่คือตัวอย่าง", "ข้อความทดสอบ", "ข้อความตัวอย่าง"],
}

#: Marks that may end a line; fixed values.
LINE_ENDS = {
    "ar": ".!?\"'؟۔؞؝:;)]»”’》",
    "tr": ".!?\"':;)]»”’",
    "hi": "।॥.!?\"':;)]»”’",
    "it": ".!?\"':;)]»”’",
    "th": "ฯ๚๛.!?\"':;)]»”’",
}

#: What brackets hold in citation and edit marks, besides a number, "edit" and "citation needed"; fixed values.
CITATIONS = {
    "ar": ["بحاجة لمصدر", "تحرير"],
    "tr": ["düzenle", "kaynak belirtilmeli"],
    "hi": ["संपादित करें", "उद्धरण आवश्यक"],
    "it": ["modifica", "senza fonte", "citazione necessaria"],
    "th": ["แก้ไข", "ต้องการอ้างอิง"],
}

#: Runs of four or more of these characters are laughter or shouting; fixed values.
LAUGHTER = {
    "ar": ["هخ", "اآ", "و", "ي"],
    "tr": ["js", "kd", "ah"],
    "hi": ["ह", "अ", "आ", "ओ", "ए"],
    "it": ["ah", "eh", "oh"],
    "th": ["5", "ก", "ค", "จ", "ฮ"],
}

#: Code points of each language's script, as ranges of a character class; fixed values.
SCRIPTS = {
    "ar": r"\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{08A0}-\x{08FF}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}",
    "tr": "a-zA-ZğĞıİöÖüÜşŞçÇ",
    "hi": r"\x{0900}-\x{097F}\x{A8E0}-\x{A8FF}\x{1CD0}-\x{1CFF}",
    "it": "a-zA-ZàÀèÈéÉìÌòÒùÙ",
    "th": r"\x{0E00}-\x{0E7F}",
}

#: Letters that only this language of its script uses; fixed values.
SPECIFIC = {"tr": "ğĞıİşŞçÇöÖüÜ", "it": "àÀèÈéÉìÌòÒùÙ"}

#: Marks that begin a list item; fixed values.
BULLETS = "•-*–►▪●"

#: Marks whose repetition is no fault; fixed values.
LEADERS = ".…-_="
