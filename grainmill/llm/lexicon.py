"""Common words of the supported languages: parameters of the text statistics."""

COMMON = {
    "it": "il lo la i gli le un uno una di a da in con su per tra fra del della dello dell all nell sull dall dei degli delle al allo alla ai agli alle dal dalla nel nella nei nelle sul sulla e ed o ma se che chi cui non come più anche dove quando quanto questo questa questi queste quello quella è sono era ha hanno si ci ne mi ti vi",
    "tr": "ve veya ya da de ki bir bu şu o için ile gibi kadar daha çok en ama fakat ancak ne mi mı mu mü var yok olan olarak sonra önce her hem ise değil diye göre ben sen biz siz onlar",
    "hi": "है हैं था थी थे का के की को से में पर ने और या एक यह वह ये वे इस उस जो तो ही भी कि नहीं न कर लिए हो अब तक साथ बाद जब तब",
    "ar": "في من إلى على عن مع أن إن لا ما لم لن هو هي هم هذا هذه ذلك تلك التي الذي الذين كان كانت قد ثم أو أم و بل كل بعد قبل بين عند حتى إذا كما لكن",
}
#: Thai writes no blanks between words; these are looked for inside its runs of letters.
COMMON_THAI = "ที่ และ ใน ของ เป็น มี ได้ ให้ ไม่ ว่า กับ จะ นี้ จาก ก็ แต่ หรือ ไป มา โดย"
#: Words that join clauses.
CONNECTIVES = {
    "it": "e ed o ma che se come dove quando perché mentre anche più non",
    "tr": "ve veya ama fakat ancak ki için ile gibi kadar olarak olan sonra daha",
    "hi": "और या कि जो तो भी ही लिए जब तब पर नहीं",
    "ar": "أن إن التي الذي ثم أو لكن بل حتى إذا كما بعد قبل قد",
}
