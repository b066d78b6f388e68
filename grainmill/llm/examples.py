"""Inspected examples, one or more of each kind of text; the mixture's components start at them."""

EXAMPLES = [
    ("prose", "La mattina il treno parte dalla stazione con qualche minuto di ritardo, ma nessuno si lamenta. I viaggiatori leggono il giornale e guardano dal finestrino le colline che cambiano colore. Quando arriva in città, la gente scende in fretta e va al lavoro."),
    ("prose", "Sabah erken saatlerde köyün yolu çok sessiz olur ve yalnız kuşların sesi gelir. Bu yol her gün okula giden çocuklar için daha güzel görünür. Akşam olunca herkes eve döner, ama bahçede oturmak isteyenler de var."),
    ("prose", "सुबह के समय गाँव की सड़क पर बहुत शांति होती है और लोग काम पर जाते हैं। बच्चे स्कूल के लिए तैयार होते हैं, लेकिन कुछ लोग देर से उठते हैं। शाम को सब लोग घर में बैठकर बात करते हैं।"),
    ("prose", "في الصباح يخرج الناس من البيوت إلى العمل و كل واحد منهم يفكر في يومه. كان الطريق بين القرية و المدينة طويلا، لكن الأطفال لا يشعرون بالتعب. بعد الظهر يعود كل منهم إلى البيت مع أصدقائه."),
    ("prose", "ตอนเช้าผู้คนในหมู่บ้านจะไปทำงานและเด็กก็ไปโรงเรียน ถนนที่ไม่มีรถเป็นที่เงียบมากแต่ว่าตอนเย็นจะมีคนมาเดินเล่นกับเพื่อน\nบ้านของเขาอยู่ใกล้แม่น้ำและมีต้นไม้ใหญ่ให้ร่มเงา"),
    ("prose", "L'internazionalizzazione dell'amministrazione rappresenta indubbiamente una trasformazione straordinariamente complessa, poiché coinvolge contemporaneamente organizzazioni governative e istituzioni universitarie. La ristrutturazione della programmazione finanziaria richiede necessariamente approfondimenti interdisciplinari."),
    ("prose", "la mattina il treno parte\ndalla stazione con\nqualche minuto di ritardo\nma nessuno si lamenta\ni viaggiatori leggono\nil giornale e guardano\ndal finestrino le colline\nche cambiano colore"),
    ("list", "• pane integrale\n• latte fresco\n• uova\n• pomodori pelati\n• olio oliva\n• sale fino\n• farina\n• zucchero canna\n• riso"),
    ("list", "Home / Notizie / Sport / Cultura / Meteo / Contatti / Archivio / Viaggi / Cucina / Salute / Motori / Lavoro"),
    ("list", "1.1 Premessa .................... 5\n1.2 Fonti ........................ 12\n2.1 Risultati .................... 48\n2.2 Tabelle ..................... 97"),
    ("list", "#viaggi #mare #estate2021 #foto #sole #amici #spiaggia #vacanze #tramonto #cibo #musica"),
    ("list", "pane € 1,20\nlatte € 0,95\nmele € 2,40\ncaffè € 5,80\nburro € 3,10\nvino € 7,90"),
    ("table", "Nome: Rossi Mario\nCittà: Torino\nNato: 1968-02-11\nTelefono: 5551234\nSocio: 40718"),
    ("table", "anno;uscite;entrate;saldo\n1990;45.20;80.11;34.91\n1991;51.00;79.35;28.35\n1992;60.70;91.42;30.72"),
    ("table", "| città | 1981 | 1991 |\n| Torino | 1117154 | 962507 |\n| Bari | 371022 | 342309 |\n| Parma | 179019 | 170520 |"),
    ("table", '{"nome": "Rossi Mario", "citta": "Torino", "socio": "40718", "nato": "1968-02-11", "stato": "attivo"}'),
    ("junk", "def conta(righe_lette, campo_chiave):\n  totale_righe = len(righe_lette[3]) + 1;\n  if (campo_chiave <= totale_righe) { return campo_chiave; }\n  // somma_parziale righe_lette"),
    ("junk", '<ul class="menu"><li id="a1"><a href="/pagina/1203">Inizio pagina</a></li>\n<li id="a2"><a href="/pagina/77">Contatti utili</a></li></ul>'),
    ("junk", "1699012345 [INFO] rete.nodo id=9f3a2b10 ms=120\n1699012399 [WARN] rete.disco id=77ab01ce ms=4410\n1699012456 [INFO] rete.nodo id=10cd93fa ms=88"),
    ("junk", "TWFuIGlzIGRpc3Rpbmd1aXNoZWQsIG5vdCBvbmx5IGJ5IGhpcyByZWFzb24sIGJ1dCBieSB0aGlzIHNpbmd1bGFyIHBhc3Npb24+aGVyLw=="),
    ("junk", "9e107d9d 372bb6826bd81d3542a419d6 04e8 1f2b77aa c0 5d41402abc4b2a76b9719d911017c592 31 9f86d081884c7d65"),
    ("junk", "▲▼ *#|<+ ★★ ◆/\\ ~~ == &&% ^^ ☆○● #*#| >>< ▲▼ || ++ ◇□ %%$ *** ~^~ ★|★ <<>> ◆◆"),
    ("junk", "asdkj qwlkejr zxmcnb poiuq lkjsdf mnbvcx qpwoei ghfjdk zmxnc vbqwe asldkf qwpoeir zxcmvn lkjhgf"),
]
