"""Top-level domains of more than two letters, as in the public suffix list that Spark's HttpClient 4.5.14 ships."""

TOP_LEVEL = frozenset(
    """
    aaa aarp abarth abb abbott abbvie abc able abogado abudhabi academy accenture accountant accountants aco
    actor ads adult aeg aero aetna afl africa agakhan agency aig airbus airforce airtel akdn alfaromeo alibaba
    alipay allfinanz allstate ally alsace alstom amazon americanexpress americanfamily amex amfam amica
    amsterdam analytics android anquan anz aol apartments app apple aquarelle arab aramco archi army arpa art
    arte asda asia associates athleta attorney auction audi audible audio auspost author auto autos avianca aws
    axa azure baby baidu banamex bananarepublic band bank bar barcelona barclaycard barclays barefoot bargains
    baseball basketball bauhaus bayern bbc bbt bbva bcg bcn beats beauty beer bentley berlin best bestbuy bet
    bharti bible bid bike bing bingo bio biz black blackfriday blockbuster blog bloomberg blue bms bmw
    bnpparibas boats boehringer bofa bom bond boo book booking bosch bostik boston bot boutique box bradesco
    bridgestone broadway broker brother brussels build builders business buy buzz bzh cab cafe cal call
    calvinklein cam camera camp canon capetown capital capitalone car caravan cards care career careers cars
    casa case cash casino cat catering catholic cba cbn cbre cbs center ceo cern cfa cfd chanel channel charity
    chase chat cheap chintai christmas chrome church cipriani circle cisco citadel citi citic city cityeats
    claims cleaning click clinic clinique clothing cloud club clubmed coach codes coffee college cologne com
    comcast commbank community company compare computer comsec condos construction consulting contact
    contractors cooking cookingchannel cool coop corsica country coupon coupons courses cpa credit creditcard
    creditunion cricket crown crs cruise cruises cuisinella cymru cyou dabur dad dance data date dating datsun
    day dclk dds deal dealer deals degree delivery dell deloitte delta democrat dental dentist desi design dev
    dhl diamonds diet digital direct directory discount discover dish diy dnp docs doctor dog domains dot
    download drive dtv dubai dunlop dupont durban dvag dvr earth eat eco edeka edu education email emerck energy
    engineer engineering enterprises epson equipment ericsson erni esq estate etisalat eurovision eus events
    exchange expert exposed express extraspace fage fail fairwinds faith family fan fans farm farmers fashion
    fast fedex feedback ferrari ferrero fiat fidelity fido film final finance financial fire firestone firmdale
    fish fishing fit fitness flickr flights flir florist flowers fly foo food foodnetwork football ford forex
    forsale forum foundation fox free fresenius frl frogans frontdoor frontier ftr fujitsu fun fund furniture
    futbol fyi gal gallery gallo gallup game games gap garden gay gbiz gdn gea gent genting george ggee gift
    gifts gives giving glass gle global globo gmail gmbh gmo gmx godaddy gold goldpoint golf goo goodyear goog
    google gop got gov grainger graphics gratis green gripe grocery group guardian gucci guge guide guitars guru
    hair hamburg hangout haus hbo hdfc hdfcbank health healthcare help helsinki here hermes hgtv hiphop
    hisamitsu hitachi hiv hkt hockey holdings holiday homedepot homegoods homes homesense honda horse hospital
    host hosting hot hoteles hotels hotmail house how hsbc hughes hyatt hyundai ibm icbc ice icu ieee ifm ikano
    imamat imdb immo immobilien inc industries infiniti info ing ink institute insurance insure int
    international intuit investments ipiranga irish ismaili ist istanbul itau itv jaguar java jcb jeep jetzt
    jewelry jio jll jmp jnj jobs joburg jot joy jpmorgan jprs juegos juniper kaufen kddi kerryhotels
    kerrylogistics kerryproperties kfh kia kids kim kinder kindle kitchen kiwi koeln komatsu kosher kpmg kpn krd
    kred kuokgroup kyoto lacaixa lamborghini lamer lancaster lancia land landrover lanxess lasalle lat latino
    latrobe law lawyer lds lease leclerc lefrak legal lego lexus lgbt lidl life lifeinsurance lifestyle lighting
    like lilly limited limo lincoln linde link lipsy live living llc llp loan loans locker locus loft lol london
    lotte lotto love lpl lplfinancial ltd ltda lundbeck luxe luxury macys madrid maif maison makeup man
    management mango map market marketing markets marriott marshalls maserati mattel mba mckinsey med media meet
    melbourne meme memorial men menu merckmsd miami microsoft mil mini mint mit mitsubishi mlb mls mma mobi
    mobile moda moe moi mom monash money monster mormon mortgage moscow moto motorcycles mov movie msd mtn mtr
    museum music mutual nab nagoya name natura navy nba nec net netbank netflix network neustar new news next
    nextdirect nexus nfl ngo nhk nico nike nikon ninja nissan nissay nokia northwesternmutual norton now nowruz
    nowtv nra nrw ntt nyc obi observer office okinawa olayan olayangroup oldnavy ollo omega one ong onion onl
    online ooo open oracle orange org organic origins osaka otsuka ott ovh page panasonic paris pars partners
    parts party passagens pay pccw pet pfizer pharmacy phd philips phone photo photography photos physio pics
    pictet pictures pid pin ping pink pioneer pizza place play playstation plumbing plus pnc pohl poker politie
    porn post pramerica praxi press prime pro prod productions prof progressive promo properties property
    protection pru prudential pub pwc qpon quebec quest racing radio read realestate realtor realty recipes red
    redstone redumbrella rehab reise reisen reit reliance ren rent rentals repair report republican rest
    restaurant review reviews rexroth rich richardli ricoh ril rio rip rocher rocks rodeo rogers room rsvp rugby
    ruhr run rwe ryukyu saarland safe safety sakura sale salon samsclub samsung sandvik sandvikcoromant sanofi
    sap sarl sas save saxo sbi sbs sca scb schaeffler schmidt scholarships school schule schwarz science scot
    search seat secure security seek select sener services ses seven sew sex sexy sfr shangrila sharp shaw shell
    shia shiksha shoes shop shopping shouji show showtime silk sina singles site ski skin sky skype sling smart
    smile sncf soccer social softbank software sohu solar solutions song sony soy spa space sport spot srl stada
    staples star statebank statefarm stc stcgroup stockholm storage store stream studio study style sucks
    supplies supply support surf surgery suzuki swatch swiss sydney systems tab taipei talk taobao target
    tatamotors tatar tattoo tax taxi tci tdk team tech technology tel temasek tennis teva thd theater theatre
    tiaa tickets tienda tiffany tips tires tirol tjmaxx tjx tkmaxx tmall today tokyo tools top toray toshiba
    total tours town toyota toys trade trading training travel travelchannel travelers travelersinsurance trust
    trv tube tui tunes tushu tvs ubank ubs unicom university uno uol ups vacations vana vanguard vegas ventures
    verisign versicherung vet viajes video vig viking villas vin vip virgin visa vision viva vivo vlaanderen
    vodka volkswagen volvo vote voting voto voyage vuelos wales walmart walter wang wanggou watch watches
    weather weatherchannel webcam weber website wedding weibo weir whoswho wien wiki williamhill win windows
    wine winners wme wolterskluwer woodside work works world wow wtc wtf xbox xerox xfinity xihuan xin xxx xyz
    yachts yahoo yamaxun yandex yodobashi yoga yokohama you youtube yun zappos zara zero zip zone zuerich
    """.split()
)
